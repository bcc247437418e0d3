"""Validation rules: row predicates and table checks compiled from a contract.

Every row rule of a contract becomes one expression of a single projection, and all counts come from
one aggregate. Uniqueness is the only rule that shuffles; its key counts are combined before the
shuffle, so a key that holds a large share of the rows does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.contract import Contract, Field, RuleSpec
from assaylake.functions.text import has_text, is_blank, iso_to_date
from assaylake.operators.keys import first_k, key_counts, with_copies
from assaylake.session import stored

SAMPLE_IDS = 5
FAILURES = "row_failures"


@dataclass(frozen=True)
class Rule:
    """A compiled rule.

    Exactly one of ``fails`` (a row predicate), ``unique`` (key columns), ``holds`` (decided
    from the schema) and ``filled`` (the table has rows) is set. A rule succeeds while its failing share is
    at most ``tolerance_pct``.
    """

    name: str
    column: str
    severity: str = "hard"
    fails: Column | None = None
    unique: tuple[str, ...] = ()
    holds: bool | None = None
    filled: bool = False
    tolerance_pct: float = 0.0

    @property
    def label(self) -> str:
        return f"{self.name}:{self.column}"


Builder = Callable[[RuleSpec], Rule]
_KINDS: dict[str, Builder] = {}
_SUITES: dict[str, tuple[RuleSpec, ...]] = {}


def rule_kind(name: str) -> Callable[[Builder], Builder]:
    """Register a kind of row rule that contracts may name."""
    def add(build: Builder) -> Builder:
        _KINDS[name] = build
        return build
    return add


def register_suite(dataset: str, rules: Iterable[RuleSpec]) -> None:
    """Extra rules for a dataset, found by its name and added to the common ones."""
    _SUITES[dataset] = tuple(rules)


def _typed(f: Field) -> Column:
    """A text column read as its declared type; unreadable text is null."""
    c = F.col(f"`{f.name}`")
    if f.dtype == "date":
        return iso_to_date(c)
    if f.dtype in ("float", "integer"):
        return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("double" if f.dtype == "float" else "bigint")
    if f.dtype == "boolean":
        return c.cast("string").try_cast("boolean")
    return c


_TEXT = "_text_"


def typed_view(df: DataFrame, contract: Contract) -> DataFrame:
    """Text columns as their declared types, the text beside them. Already typed columns stay.

    Each text is read once; the rules on its values and the rule on its type share the outcome.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [f for f in contract.fields if f.name in kinds and f.dtype in ("float", "integer", "date")]
    kept = df.withColumns({f"{_TEXT}{f.name}": F.col(f"`{f.name}`").cast("string") for f in fields}) if fields else df
    text = [f for f in fields if isinstance(kinds[f.name], T.StringType)]
    return kept.withColumns({f.name: _typed(f) for f in text}) if text else kept


def without_text(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_TEXT)])


@rule_kind("not_null")
def _not_null(spec: RuleSpec) -> Rule:
    return Rule("not_null", spec.column, spec.severity, F.col(f"`{spec.column}`").isNull())


@rule_kind("not_blank")
def _not_blank(spec: RuleSpec) -> Rule:
    return Rule("not_blank", spec.column, spec.severity, is_blank(F.col(f"`{spec.column}`")))


@rule_kind("unique")
def _unique(spec: RuleSpec) -> Rule:
    keys = tuple(spec.params.get("keys") or (spec.column,))
    return Rule("unique", ",".join(keys), spec.severity, unique=keys)


@rule_kind("in_set")
def _in_set(spec: RuleSpec) -> Rule:
    c = F.col(f"`{spec.column}`")
    return Rule("in_set", spec.column, spec.severity,
                F.coalesce(~c.isin(list(spec.params["values"])), F.lit(False)))


@rule_kind("minimum")
def _minimum(spec: RuleSpec) -> Rule:
    return Rule("minimum", spec.column, spec.severity,
                F.coalesce(F.col(f"`{spec.column}`") < F.lit(spec.params["low"]), F.lit(False)))


@rule_kind("between")
def _between(spec: RuleSpec) -> Rule:
    c, low, high = F.col(f"`{spec.column}`"), spec.params.get("low"), spec.params.get("high")
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < (F.lit(low).cast("date") if isinstance(low, str) else F.lit(low)))
    if high is not None:
        bad = bad | (c > (F.lit(high).cast("date") if isinstance(high, str) else F.lit(high)))
    return Rule("between", spec.column, spec.severity, F.coalesce(bad, F.lit(False)))


def _pair(name: str, spec: RuleSpec, bad: Callable[[Column, Column], Column]) -> Rule:
    a, b = F.col(f"`{spec.column}`"), F.col(f"`{spec.params['other']}`")
    return Rule(name, spec.column, spec.severity, F.coalesce(bad(a, b), F.lit(False)))


@rule_kind("pair_at_least")
def _pair_at_least(spec: RuleSpec) -> Rule:
    return _pair("pair_at_least", spec, lambda a, b: a < b)


@rule_kind("pair_at_most")
def _pair_at_most(spec: RuleSpec) -> Rule:
    return _pair("pair_at_most", spec, lambda a, b: a > b)


@rule_kind("pair_above")
def _pair_above(spec: RuleSpec) -> Rule:
    """Strictly above; rows where either side is missing are skipped."""
    return _pair("pair_above", spec, lambda a, b: a <= b)


def compile_rules(specs: Iterable[RuleSpec]) -> list[Rule]:
    """Declared rules as compiled ones."""
    out = []
    for spec in specs:
        if spec.kind not in _KINDS:
            raise KeyError(f"rule {spec.rule_id}: unknown kind {spec.kind!r}; known: {sorted(_KINDS)}")
        out.append(_KINDS[spec.kind](spec))
    return out


def readable(f: Field, severity: str = "hard") -> Rule:
    """Fails where text is present but is not of the declared type."""
    return Rule("type", f.name, severity, has_text(F.col(f"`{_TEXT}{f.name}`")) & F.col(f"`{f.name}`").isNull())


def contract_rules(contract: Contract, columns: Sequence[str], strict: bool = False) -> list[Rule]:
    """The common rules of a contract, its declared ones and any registered suite.

    ``strict`` makes every rule hard; otherwise the contract's soft categories and severities hold.
    """
    soft = set(contract.soft_categories)

    def level(category: str, default: str = "hard") -> str:
        return "soft" if category in soft else default

    present = [f for f in contract.fields if f.name in columns]
    specs = [RuleSpec(f"{f.name}_present", "not_null", f.name, level("null_check"))
             for f in present if f.required]
    specs += [RuleSpec(f"{c}_unique", "unique", c, level("duplicate_check"))
              for c in contract.unique_fields if c in columns]
    specs += [RuleSpec(f"{f.name}_permitted", "in_set", f.name, level("permissible_values"), {"values": f.allowed})
              for f in present if f.allowed]
    specs += [RuleSpec(f"{f.name}_minimum", "minimum", f.name, "soft", {"low": f.minimum})
              for f in present if f.minimum is not None]
    declared = [*contract.rules, *_SUITES.get(contract.dataset, ())]
    specs += [s for s in declared if s.kind != "schema" and (s.column is None or s.column in columns)]
    rules = {r.label: r for r in compile_rules(specs)}  # a declared rule replaces its common twin
    same = set(columns) == set(contract.names)
    schema_level = next((s.severity for s in declared if s.kind == "schema"), level("schema_validation"))
    out = [Rule("columns_match", "*", schema_level, holds=same), *rules.values()]
    out += [readable(f, level("schema_validation")) for f in present if f.dtype in ("float", "integer", "date")]
    if strict:
        out = [Rule(r.name, r.column, "hard", r.fails, r.unique, r.holds, r.tolerance_pct) for r in out]
    return out


def judged(df: DataFrame, contract: Contract, strict: bool = False) -> tuple[DataFrame, list[Rule]]:
    """Staged text ready for evaluation, with the rules of its contract."""
    return typed_view(df, contract), contract_rules(contract, df.columns, strict)


# --- evaluation ------------------------------------------------------------------------------------

def flagged(df: DataFrame, rules: Sequence[Rule], into: str = FAILURES) -> DataFrame:
    """Every row with the labels of the rules it breaks. Uniqueness marks all copies."""
    columns = df.columns
    for i, rule in enumerate(rules):
        if rule.unique:
            df = with_copies(df, rule.unique, f"_u{i}")
    labels = [
        F.when(F.col(f"_u{i}") > 1 if r.unique else r.fails, F.lit(r.label))
        for i, r in enumerate(rules) if r.unique or r.fails is not None
    ]
    failures = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    return df.select(*columns, failures.alias(into))


def split(df: DataFrame, failures: str = FAILURES, labels: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rows to quarantine. With labels only those rules send a row away."""
    broken = F.col(failures)
    if labels is not None:
        wanted = F.array(*[F.lit(x) for x in labels]) if labels else F.array().cast("array<string>")
        broken = F.array_intersect(broken, wanted)
    return df.filter(F.size(broken) == 0), df.filter(F.size(broken) > 0)


def split_once(df: DataFrame, failures: str = FAILURES, labels: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``split`` of rows whose rules are evaluated once, into a stored table."""
    return split(stored(df, "flagged"), failures, labels)


def hard_labels(rules: Sequence[Rule]) -> list[str]:
    return [r.label for r in rules if r.severity == "hard"]


def _counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: ``rows``, ``flagged`` and a failed count ``c0..`` per rule.

    The first unique key is counted by grouping on it, carrying the other counts along; no row is
    joined back. Only further unique keys need a join.
    """
    unique = [i for i, r in enumerate(rules) if r.unique]
    first, further = (unique[0], unique[1:]) if unique else (None, [])
    for i in further:
        df = with_copies(df, rules[i].unique, f"_u{i}")
    fails = {i: (F.col(f"_u{i}") > 1 if i in further else r.fails)
             for i, r in enumerate(rules) if i in further or r.fails is not None}
    df = df.select(*(rules[first].unique if first is not None else ()),
                   *[F.when(f, 1).otherwise(0).cast("bigint").alias(f"_f{i}") for i, f in fails.items()])
    any_fail = F.greatest(F.lit(0), F.lit(0), *[F.col(f"_f{i}") for i in fails]).cast("bigint")
    sums = [F.sum(f"_f{i}").alias(f"c{i}") for i in fails]
    if first is None:
        out = df.agg(F.count("*").alias("rows"), F.sum(any_fail).alias("flagged"), *sums)
    else:
        keys = rules[first].unique
        grouped = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(any_fail).alias("bad"), *sums)
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        repeated = keyed & (F.col("n") > 1)
        out = grouped.agg(
            F.sum("n").alias("rows"), F.sum(F.when(repeated, F.col("n")).otherwise(F.col("bad"))).alias("flagged"),
            *[F.sum(f"c{i}").alias(f"c{i}") for i in fails],
            F.sum(F.when(repeated, F.col("n")).otherwise(0)).alias(f"c{first}"))
    zero = F.lit(0).cast("bigint")
    def count(i: int, r: Rule) -> Column:
        if r.filled:
            return F.when(F.coalesce("rows", zero) == 0, 1).otherwise(0).cast("bigint")
        return F.coalesce(f"c{i}", zero) if r.holds is None else F.lit(0 if r.holds else 1).cast("bigint")

    counts = [count(i, r).alias(f"c{i}") for i, r in enumerate(rules)]
    return out.select(F.coalesce("rows", zero).alias("rows"), F.coalesce("flagged", zero).alias("flagged"), *counts)


def _samples(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Up to five failing ids per rule, lowest first. Cut to five in every map task."""
    parts = []
    row_rules = [r for r in rules if r.fails is not None]
    if row_rules:
        labels = F.array_compact(F.array(*[F.when(r.fails, F.lit(r.label)) for r in row_rules]))
        parts.append(df.select(F.explode(labels).alias("label"), F.col(key).cast("string").alias("id")))
    for rule in rules:
        if rule.unique:
            repeated = key_counts(df, rule.unique).filter(F.col("copies") > 1)
            name = F.concat_ws(",", *[F.col(k).cast("string") for k in rule.unique])
            shown = F.explode(F.array_repeat(name, F.least("copies", F.lit(SAMPLE_IDS)).cast("int")))
            parts.append(repeated.select(F.lit(rule.label).alias("label"), shown.alias("id")))
    if not parts:
        return df.sparkSession.createDataFrame([], "label string, sample_ids array<string>")
    rows = reduce(DataFrame.unionByName, parts)
    top = first_k(rows.filter(F.col("id").isNotNull()), ["label"], [F.col("id")], SAMPLE_IDS)
    return top.groupBy("label").agg(F.array_sort(F.collect_list("id")).alias("sample_ids"))


def _succeeds(rule: Rule, failed: Column, rows: Column) -> Column:
    if rule.filled:
        return failed == 0
    share = F.coalesce(failed * 100.0 / F.nullif(rows, F.lit(0)), F.lit(0.0))
    return (failed == 0) | (share <= rule.tolerance_pct)


def judged_once(df: DataFrame, rules: Sequence[Rule], key: str) -> tuple[DataFrame, list[Rule]]:
    """The key, the unique columns and the outcome of every row rule, written in one pass, and the rules over that table."""
    unique = list(dict.fromkeys(c for r in rules for c in r.unique))
    flags = {i: r.fails for i, r in enumerate(rules) if r.fails is not None}
    rows = stored(df.select(F.col(key).alias("_id"), *[F.col(c).alias(f"_unique{n}") for n, c in enumerate(unique)],
                            *[F.coalesce(f, F.lit(False)).alias(f"_fails{i}") for i, f in flags.items()]), "judged")
    return rows, [replace(r, fails=F.col(f"_fails{i}") if i in flags else None, unique=tuple(f"_unique{unique.index(c)}" for c in r.unique))
                  for i, r in enumerate(rules)]


def rule_results(df: DataFrame, rules: Sequence[Rule], key: str | None = None) -> DataFrame:
    """One row per rule: severity, success, how many rows fail of how many, sample ids.

    With a ``key`` the rows are judged once into a narrow table, from which counts and samples are taken.
    """
    if key is not None:
        df, rules = judged_once(df, rules, key)
        key = "_id"
    counts = _counts(df, rules)
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
            F.lit(r.severity).alias("severity"), _succeeds(r, F.col(f"c{i}"), F.col("rows")).alias("success"),
            F.col(f"c{i}").alias("failed_count"), F.col("rows").alias("row_count"), F.lit(r.label).alias("label"))
        for i, r in enumerate(rules)
    ]
    long = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    if key is None:
        return long.drop("label").withColumn("sample_ids", F.array().cast("array<string>"))
    out = long.join(_samples(df, rules, key), "label", "left").drop("label")
    return out.withColumn("sample_ids", F.coalesce("sample_ids", F.array().cast("array<string>")))


def report(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row: rows, quality by rows and by batch, failed rules by severity, whether it passes.

    An empty table never passes and scores 0.
    """
    c = _counts(df, rules)
    failed = {
        level: reduce(lambda a, b: a + b, [
            F.when(_succeeds(r, F.col(f"c{i}"), F.col("rows")), 0).otherwise(1)
            for i, r in enumerate(rules) if r.severity == level], F.lit(0))
        for level in ("hard", "soft")
    }
    passes = (failed["hard"] == 0) & (F.col("rows") > 0)
    by_rows = F.round((F.lit(1.0) - F.col("flagged") / F.nullif(F.col("rows"), F.lit(0))) * 100, 1)
    return c.select(
        F.lit(dataset).alias("dataset"), F.col("rows").alias("row_count"), F.col("flagged").alias("flagged_rows"),
        failed["hard"].cast("bigint").alias("hard_failures"), failed["soft"].cast("bigint").alias("soft_warnings"),
        passes.alias("hard_rule_pass"), F.coalesce(by_rows, F.lit(0.0)).alias("dqi_rows"),
        F.when((failed["hard"] + failed["soft"] == 0) & (F.col("rows") > 0), 100.0).otherwise(0.0).alias("dqi_binary"))


def failed_rules(results: DataFrame, severity: str = "hard") -> DataFrame:
    """Names of the rules that failed."""
    return results.filter((F.col("severity") == severity) & ~F.col("success")).select("rule", "column")


def quality_index(failures: Column) -> Column:
    """Share of rows without a failure, in percent; 0 for no rows."""
    return F.coalesce(F.round(F.avg(F.when(F.size(failures) > 0, 0.0).otherwise(1.0)) * 100, 1), F.lit(0.0))


def model_tests(tests: Mapping[str, Sequence[RuleSpec]], layers: Mapping[str, DataFrame]) -> DataFrame:
    """Checks to run after a layer is built: one row per test with its severity and failures."""
    parts = []
    for layer, specs in tests.items():
        rules = compile_rules(specs)
        parts.append(rule_results(layers[layer], rules).select(
            F.lit(layer).alias("layer"), "rule", "column", "severity", "success", "failed_count"))
    return reduce(DataFrame.unionByName, parts)


def not_empty(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row telling whether any row meets the condition."""
    matched = df.filter(condition) if condition is not None else df
    return matched.agg(F.count("*").alias("row_count")).withColumn("success", F.col("row_count") > 0)
