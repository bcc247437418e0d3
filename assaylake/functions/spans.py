"""Finding and replacing personal data in text with Spark expressions.

A span is ``struct<entity, start, end, score>`` with zero-based offsets, end exclusive. Positions come
from cutting the whole text at a pattern and adding up the lengths of what lies between the hits.

The expressions are written as SQL text: a detection has thousands of nodes, and handing Spark one
string is far quicker than building it node by node. Inputs are therefore column names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "struct<entity:string,start:int,end:int,score:double>"
SPANS_TYPE = f"array<{SPAN_TYPE}>"

# A context word among the words before a hit raises its score by BOOST, to BOOST_FLOOR at least.
BOOST = 0.35
BOOST_FLOOR = 0.4
CONTEXT_WORDS = 5


@dataclass(frozen=True)
class Recognizer:
    """One pattern for one kind of personal data. The pattern must have no capturing group."""

    entity: str
    name: str
    pattern: str
    score: float
    context: tuple[str, ...] = ()
    needs: str | None = None  # a cheap pattern every hit contains, checked before the costly one
    look: str | None = None  # a cheaper one still, shared by many recognizers; needs stands in for it


_DIGITS = r"\d{3}"

# Patterns, base scores and context words of the regional identifiers.
REGIONAL_RECOGNIZERS = (
    Recognizer("PH_PHONE", "ph_mobile", r"(?:\+63|0063|0)[\s-]?9\d{2}[\s-]?\d{3}[\s-]?\d{4}", 0.7,
               ("mobile", "cell", "phone", "contact", "call", "viber"), r"\d{3}", _DIGITS),
    Recognizer("PH_PHONE", "ph_metro_manila", r"(?:\(0?2\)|\b02)[\s-]?\d{4}[\s-]?\d{4}", 0.6,
               ("landline", "phone", "tel", "contact", "call"), r"\d{4}", _DIGITS),
    Recognizer("PH_PHILSYS", "philsys", r"\b\d{4}-\d{4}-\d{4}(?:-\d{4})?\b", 0.6,
               ("philsys", "national id", "psn", "pcn"), r"\d{4}-\d{4}", _DIGITS),
    Recognizer("PH_TIN", "tin", r"\b\d{3}-\d{3}-\d{3}(?:-\d{3,5})?\b", 0.6, ("tin", "tax"), r"\d{3}-\d{3}", _DIGITS),
    Recognizer("PH_SSS", "sss", r"\b\d{2}-\d{7}-\d\b", 0.6, ("sss",), r"\d{7}", _DIGITS),
    Recognizer("PH_GSIS", "gsis", r"\b\d{11}\b", 0.2, ("gsis", "bp number", "crn"), r"\d{11}", _DIGITS),
)

# Stand-ins for a language model's generic recognizers: e-mail, international phone numbers and
# names behind a title. Their recall is below a model's; plug one in with `udf_spans`.
GENERIC_RECOGNIZERS = (
    Recognizer("EMAIL_ADDRESS", "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 1.0, (), "@"),
    Recognizer("PHONE_NUMBER", "intl_phone", r"(?:\+\d{1,3}[\s-])?\(\d{3}\)[\s-]?\d{3}[\s-]\d{4}\b", 0.4,
               ("phone", "number", "telephone", "cell", "mobile", "call"), r"\(\d{3}\)", _DIGITS),
    Recognizer("PERSON", "titled_name",
               r"\b(?:Engr|Dr|Mr|Mrs|Ms|Atty|Prof|Hon)\.?\s(?:[A-Z]\.\s)?[A-Z][a-z]+"
               r"(?:\s(?:de|dela|del|la|los|san|[A-Z][a-z]+)){0,3}\b", 0.6, (),
               r"\b(?:Engr|Dr|Mr|Mrs|Ms|Atty|Prof|Hon)\b"),
)

DEFAULT_RECOGNIZERS = GENERIC_RECOGNIZERS + REGIONAL_RECOGNIZERS
GOVERNMENT_IDS = ("PH_PHILSYS", "PH_TIN", "PH_SSS", "PH_GSIS")
DEFAULT_ENTITIES = ("PERSON", "EMAIL_ADDRESS", "PHONE_NUMBER", "PH_PHONE") + GOVERNMENT_IDS


_NONE = f"cast(array() as {SPANS_TYPE})"


def _quoted(text: str) -> str:
    """A raw string literal, so that patterns keep their backslashes."""
    if "'" in text:
        raise ValueError("patterns may not hold a single quote")
    return f"r'{text}'"


def column(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A plain string as SQL text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _has(text: str, look: str) -> str:
    plain = look.isalnum() or look == "@"
    return f"contains({text}, '{look}')" if plain else f"{text} rlike {_quoted(look)}"


# ``aggregate`` copies its state at every step, so nothing below lets a state grow with the number of hits.

def _running(values: str, start: str, step: str) -> str:
    """Running totals of an array, each with its own value: by blocks as long as there are blocks."""
    def total(part: str, first: str) -> str:
        return f"aggregate({part}, {first}, {step})"

    blocks = "sequence(0, (size(v) - 1) div b)"
    within = f"transform(slice(v, j * b + 1, b), (x, i) -> {total('slice(v, j * b + 1, i + 1)', total('slice(t, 1, j)', start))})"
    sums = f"transform({blocks}, j -> {total('slice(v, j * b + 1, b)', start)})"
    by_block = f"transform(array({sums}), t -> flatten(transform(t, (s, j) -> {within})))[0]"
    sized = f"transform(array(cast(ceil(sqrt(size(v))) as int)), b -> {by_block})[0]"
    return f"transform(array({values}), v -> if(size(v) = 0, cast(array() as array<int>), {sized}))[0]"


_LAST_WORDS = _quoted(rf"^\w*(?:\W+\w+){{0,{CONTEXT_WORDS}}}")
_ENOUGH = _quoted(rf"^\w*(?:\W+\w+){{{CONTEXT_WORDS}}}\W")
_NEAR = 8  # stretches between hits that are looked at for context words before the whole text is


def _score(text: str, start: str, recognizer: Recognizer) -> str:
    """The score of hit ``i`` of ``z``, by the words before it."""
    base = f"{recognizer.score}D"
    if not recognizer.context:
        return base
    boosted = min(1.0, max(recognizer.score + BOOST, BOOST_FLOOR))
    first = f"greatest(i - {_NEAR - 1}, 0)"
    between = f"slice(z.p, {first} + 1, i - {first} + 1)"
    near = f"reverse(array_join(zip_with({between}, slice(z.h, {first} + 1, i - {first}), (p, h) -> concat(p, coalesce(h, ''))), ''))"
    # read backwards the last words come first; if they may go on before the stretches at hand, all text before the hit is read
    before = f"transform(array({near}), n -> if({first} = 0 or n rlike {_ENOUGH}, n, reverse(left({text}, {start}))))[0]"
    found = f"lower(reverse(regexp_extract({before}, {_LAST_WORDS}, 0))) rlike {_quoted('|'.join(recognizer.context))}"
    return f"if({found}, {boosted}D, {base})"


def _hits(text: str, recognizer: Recognizer) -> str:
    """Every hit of one recognizer in the whole text."""
    pattern = _quoted(recognizer.pattern)
    sizes = "zip_with(z.h, slice(z.p, 1, size(z.h)), (h, p) -> length(h) + length(p))"
    start = "(ends[i] - length(hit))"
    span = (f"named_struct('entity', {literal(recognizer.entity)}, 'start', {start}, 'end', ends[i], "
            f"'score', {_score(text, start, recognizer)})")
    spans = (
        f"transform(array(named_struct('p', split({text}, {pattern}, -1), 'h', regexp_extract_all({text}, {pattern}, 0))), z -> "
        f"transform(array({_running(sizes, '0', '(a, x) -> a + x')}), ends -> transform(z.h, (hit, i) -> {span}))[0])[0]")
    # positions are worked out only where there is a hit
    there = f"{text} rlike {pattern}"
    return f"if({f'{_has(text, recognizer.needs)} and {there}' if recognizer.needs else there}, {spans}, {_NONE})"


def _merged(spans: str) -> str:
    """Overlapping spans joined: the union of their range, the entity of the best score.

    On equal scores the earlier span wins.
    """
    ordered = (f"array_sort(transform({spans}, s -> named_struct('start', s.start, 'rank', -s.score, "
               f"'end', s.end, 'entity', s.entity, 'score', s.score)))")
    fresh = f"cast(named_struct('entity', s.entity, 'start', s.start, 'end', s.end, 'score', s.score) as {SPAN_TYPE})"
    apart = "not exists(zip_with(slice(o, 1, size(o) - 1), slice(o, 2, size(o)), (s, t) -> t.start < s.end), f -> f)"
    joined = (f"cast(named_struct('entity', if(m.score >= s.score, m.entity, s.entity), 'start', least(m.start, s.start), "
              f"'end', greatest(m.end, s.end), 'score', greatest(m.score, s.score)) as {SPAN_TYPE})")
    reach = _running("transform(o, s -> s.end)", "-1", "(a, x) -> greatest(a, x)")
    # groups of spans that overlap begin where a span starts behind all before it
    begins = f"transform(array({reach}), r -> filter(sequence(1, size(o)), k -> k = 1 or o[k - 1].start >= r[k - 2]))[0]"
    group = "slice(o, g, coalesce(get(gs, n + 1), size(o) + 1) - g)"
    one = f"aggregate({group}, cast(null as {SPAN_TYPE}), (m, s) -> if(m is null, {fresh}, {joined}))"
    groups = f"transform(array({begins}), gs -> transform(gs, (g, n) -> {one}))[0]"
    return (f"if(size({spans}) > 1, transform(array({ordered}), o -> if({apart}, transform(o, s -> {fresh}), {groups}))[0], {spans})")


def merged(spans: str) -> Column:
    """The spans of a column with overlapping ones joined."""
    return F.expr(_merged(column(spans)))


def detected(
    text: str,
    entities: Sequence[str] = DEFAULT_ENTITIES,
    threshold: float = 0.4,
    recognizers: Sequence[Recognizer] = DEFAULT_RECOGNIZERS,
) -> Column:
    """Merged spans of the wanted entities at or above the score threshold; empty for blank text."""
    wanted = [r for r in recognizers if r.entity in entities
              and (r.score >= threshold or (r.context and max(r.score + BOOST, BOOST_FLOOR) >= threshold))]
    if not wanted:
        return F.expr(_NONE)
    source = column(text)
    found = f"concat({', '.join(_hits(source, r) for r in wanted)})"
    if any(r.score < threshold for r in wanted):
        found = f"filter({found}, s -> s.score >= {threshold}D)"
    # naming the unmerged spans once keeps them from being worked out for each mention
    found = f"transform(array({found}), hits -> {_merged('hits')})[0]"
    # most text holds neither three digits in a row, an @ nor a title: a few cheap looks settle it
    looks = dict.fromkeys(r.look or r.needs for r in wanted)
    gate = " or ".join(_has(source, look) for look in looks) if all(looks) else f"{source} is not null"
    return F.expr(f"if(coalesce({gate}, false), {found}, {_NONE})")


def replaced(text: str, spans: str, only: Sequence[str] | None = None) -> Column:
    """The text with each span replaced by ``<ENTITY>``. Spans must be merged and in order."""
    source, chosen = column(text), column(spans)
    if only is not None:
        chosen = f"filter({chosen}, s -> s.entity in ({', '.join(literal(e) for e in only)}))"
    kept = f"substring({source}, state.at + 1, s.start - state.at)"
    done = (f"aggregate({chosen}, named_struct('out', '', 'at', 0), "
            f"(state, s) -> named_struct('out', concat(state.out, {kept}, '<', s.entity, '>'), 'at', s.end), "
            f"state -> concat(state.out, substring({source}, state.at + 1, length({source}))))")
    return F.expr(f"if(size({column(spans)}) > 0, {done}, {source})")
