"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

* Documents fall into cells, one for each combination of the dimensions (source, language, topic). Fitting works
  on the tokens of cells and rescales them in turn until every dimension has its target shares.
* A document's probability is its cell's fitted weight per token times one factor for all cells, at most 1; the
  factor is the one for which the expected tokens meet the budget.
* A document is drawn if a hash of its id, spread evenly over [0, 1), is below its probability: the same
  documents at every run, on any cluster. Rows with equal ids are drawn together.

A null is a value of its own in every dimension. Target values that the corpus lacks count for nothing, corpus
values without a target are not drawn; cells without tokens get probability 0. An empty corpus gives no rows.
Up to ``SMALL_CELLS`` cells - a few dozen bytes each, however large the corpus - are fitted as arrays on the driver and broadcast;
beyond that the same steps run as joins and sums over the table of cells, and documents join it by key.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

ROUNDS = 10
TOLERANCE = 1e-9
SMALL_CELLS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def key(c: Column | str) -> Column:
    """A dimension's value for joins: nulls count as one value, unlike any other."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def spread(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share): the dimension's shares of tokens raised to a power, so that large ones give way to small."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    sums = sums.select("value", F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("share"))
    total = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.select("value", (F.col("share") / F.lit(total)).alias("share"))


def fitted(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimension keys, tokens) with ``weight``, whose shares meet the targets in every dimension.

    Every rescaling sums the weights by one dimension (combined before the shuffle) and joins the factors back;
    one round is written and reread, which keeps the plan short.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    current = stored(cells.withColumn("weight", F.col("tokens") / F.lit(float(total))), "fit")
    targets = {name: stored(t.groupBy("value").agg(F.sum("share").alias("share")), "targets") for name, t in targets.items()}
    # only values that the corpus has, scaled to one
    for name, target in targets.items():
        have = target.join(current.where("tokens > 0").select(F.col(name).alias("value")).distinct(), "value", "left_semi")
        whole = have.agg(F.sum("share")).first()[0] or 1.0
        targets[name] = have.select("value", (F.col("share") / F.lit(whole)).alias("share"))
    for _ in range(rounds):
        before = current
        for name, target in targets.items():
            sums = current.groupBy(F.col(name).alias("value")).agg(F.sum("weight").alias("held"))
            factors = sums.join(target, "value", "left").select(
                F.col("value").alias(name), F.when(F.col("held") > 0, F.coalesce("share", F.lit(0.0)) / F.col("held"))
                .otherwise(F.lit(0.0)).alias("factor"))
            current = current.join(factors, name).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        current = stored(current.select(before.columns), "fit")
        dims = list(targets)
        moved = current.join(before.select(*dims, F.col("weight").alias("old")), dims).agg(
            F.max(F.when(F.col("weight") > 0, F.abs(F.col("weight") - F.col("old")) / F.col("weight")))).first()[0]
        if (moved or 0.0) < TOLERANCE:
            break
    return current


def calibrated(cells: DataFrame, budget: float, steps: int = 200) -> DataFrame:
    """``cells`` with ``probability``: weights per token times one factor, at most 1, with ``budget`` expected tokens."""
    gain = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    cells = stored(cells.withColumn("gain", gain), "gains")
    factor = 0.0
    for _ in range(steps):
        full = F.col("gain") * F.lit(factor) >= 1
        row = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
                        F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        after = max(factor, (budget - row["full"]) / row["open"])
        if after <= factor * (1 + 1e-15):
            break
        factor = after
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("gain") * F.lit(factor))).drop("gain")


def fitted_small(cells: pd.DataFrame, aims: dict[str, pd.Series], rounds: int = ROUNDS) -> np.ndarray:
    """The weights of ``fitted`` for cells held as arrays; ``aims``: share by value."""
    tokens = cells["tokens"].to_numpy(float)
    weight = tokens / max(tokens.sum(), 1.0)
    codes, shares = {}, {}
    for name, aim in aims.items():
        codes[name], values = pd.factorize(cells[name])
        share = aim.reindex(values).fillna(0.0).to_numpy(float)
        share = np.where(np.bincount(codes[name], tokens, len(values)) > 0, share, 0.0)
        shares[name] = share / (share.sum() or 1.0)
    for _ in range(rounds):
        before = weight
        for name, code in codes.items():
            held = np.bincount(code, weight, len(shares[name]))
            weight = weight * np.divide(shares[name], held, out=np.zeros(len(held)), where=held > 0)[code]
        some = weight > 0
        if not some.any() or (np.abs(weight - before)[some] / weight[some]).max() < TOLERANCE:
            break
    return weight


def calibrated_small(tokens: np.ndarray, weight: np.ndarray, budget: float) -> np.ndarray:
    """The probabilities of ``calibrated`` for arrays."""
    gain = np.divide(weight, tokens, out=np.zeros(len(weight)), where=tokens > 0)
    factor = 0.0
    while True:
        full = gain * factor >= 1
        rest = weight[~full].sum()
        after = max(factor, (budget - tokens[full].sum()) / rest) if rest else factor
        if after <= factor * (1 + 1e-15):
            return np.minimum(1.0, gain * factor)
        factor = after


def tempered_small(cells: pd.DataFrame, dimension: str, power: float) -> pd.Series:
    sums = cells.groupby(dimension)["tokens"].sum()
    return sums[sums > 0].astype(float) ** power


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(docs: DataFrame, dimensions: dict[str, Column], tokens: Column, powers: dict[str, float], *,
          share: float, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``_mix_tokens`` and ``_mix_probability``; draw those with ``spread(doc_id) < _mix_probability``.

    ``dimensions`` are expressions on ``docs``, ``share`` is the part of all tokens to expect. A dimension without
    a table in ``targets`` (value, share) is tempered by its power.
    """
    names = list(dimensions)
    keyed = docs.select("*", tokens.alias("_mix_tokens"), *[key(c).alias(f"_mix_{n}") for n, c in dimensions.items()])
    cells = keyed.groupBy(*[F.col(f"_mix_{n}").alias(n) for n in names]).agg(F.sum("_mix_tokens").alias("tokens"))
    cells = stored(cells, "cells")
    given = {n: targets[n].select(key("value").alias("value"), "share") for n in names if targets and n in targets}
    if cells.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS:
        here = cells.toPandas()
        aims = {}
        for n in names:
            if n in given:
                have = given[n].join(cells.select(F.col(n).alias("value")).distinct(), "value", "left_semi")
                aims[n] = have.toPandas().groupby("value")["share"].sum()
            else:
                aims[n] = tempered_small(here, n, powers[n])
        amounts = here["tokens"].to_numpy(float)
        here["_mix_probability"] = calibrated_small(amounts, fitted_small(here, aims, rounds), share * amounts.sum())
        rows = [tuple(map(str, r[:-1])) + (float(r[-1]),) for r in here[[*names, "_mix_probability"]].itertuples(index=False)]
        chances = F.broadcast(docs.sparkSession.createDataFrame(
            rows, ", ".join(f"`_mix_{n}` string" for n in names) + ", _mix_probability double"))
    else:
        aims = {n: given[n] if n in given else tempered(cells, n, powers[n]) for n in names}
        total = cells.agg(F.sum("tokens")).first()[0] or 0
        done = stored(calibrated(fitted(cells, aims, rounds), share * total), "probabilities")
        chances = done.select(*[F.col(n).alias(f"_mix_{n}") for n in names], F.col("probability").alias("_mix_probability"))
    return keyed.join(chances, [f"_mix_{n}" for n in names]).drop(*[f"_mix_{n}" for n in names])


# ---- the mix that query and pipeline use

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
SHARE = 0.6

#: Marks of a topic, in order of precedence; a text without any is "prose".
TOPICS = (("legal", ("License", "Copyright", "copyright")), ("contact", ("@", "+1-", "tel:")), ("markup", ("%%%", "###", " | ")))


def topic_of(text: Column) -> Column:
    """A coarse topic by marks anywhere in the text."""
    found = None
    for name, marks in TOPICS:
        has = reduce(lambda a, b: a | b, [text.contains(m) for m in marks])
        found = F.when(has, name) if found is None else found.when(has, name)
    return found.otherwise("prose")


def sampled_mix(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, sampled) for every row of ``docs``."""
    narrow = stored(docs.select("doc_id", "source", "lang", topic_of(F.col("text")).alias("topic"),
                                tokens_of(F.col("text")).alias("n_tokens")), "mix")
    out = mixed(narrow, {n: F.col(n) for n in POWERS}, F.col("n_tokens"), POWERS, share=share)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("_mix_probability", 6).alias("probability"),
                      (spread(F.col("doc_id")) < F.col("_mix_probability")).alias("sampled"))


def _sql() -> str:
    topic = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(text, '{m}')" for m in marks) + f" THEN '{name}'"
                               for name, marks in TOPICS) + " ELSE 'prose' END"
    dims = ", ".join(POWERS)
    keys = ", ".join(f"coalesce('=' || {n}, 'null') AS {n}" for n in POWERS)
    parts = [
        f"docs AS MATERIALIZED (SELECT doc_id, source, lang, {topic} AS topic, CAST(coalesce(length(regexp_extract_all(text, "
        f"'[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents)",
        f"cells AS MATERIALIZED (SELECT {dims}, sum(n_tokens)::DOUBLE AS tokens FROM (SELECT {keys}, n_tokens FROM docs) GROUP BY ALL)",
    ]
    for n, power in POWERS.items():
        parts.append(f"raw_{n} AS MATERIALIZED (SELECT {n}, pow(sum(tokens), {power}) AS share FROM cells GROUP BY {n} HAVING sum(tokens) > 0)")
        parts.append(f"aim_{n} AS MATERIALIZED (SELECT {n}, share / (SELECT sum(share) FROM raw_{n}) AS share FROM raw_{n})")
    parts.append(f"fit_0 AS MATERIALIZED (SELECT {dims}, tokens, tokens / (SELECT sum(tokens) FROM cells) AS weight FROM cells)")
    step = 0
    for _ in range(ROUNDS):
        for n in POWERS:
            others = ", ".join(f"c.{d}" for d in POWERS)
            parts.append(
                f"fit_{step + 1} AS MATERIALIZED (SELECT {others}, c.tokens, c.weight * CASE WHEN h.held > 0 THEN coalesce(a.share, 0) / h.held ELSE 0 END AS weight "
                f"FROM fit_{step} c JOIN (SELECT {n}, sum(weight) AS held FROM fit_{step} GROUP BY {n}) h USING ({n}) LEFT JOIN aim_{n} a USING ({n}))")
            step += 1
    budget = f"(SELECT {SHARE} * sum(tokens) FROM cells)"
    parts += [
        f"gains AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS gain FROM fit_{step})",
        "levels AS MATERIALIZED (SELECT gain, sum(tokens) AS tokens, sum(weight) AS weight FROM gains WHERE gain > 0 GROUP BY gain)",
        "above AS MATERIALIZED (SELECT gain, coalesce(sum(tokens) OVER higher, 0) AS full_tokens, (SELECT sum(weight) FROM levels) - "
        "coalesce(sum(weight) OVER higher, 0) AS open_weight FROM levels WINDOW higher AS (ORDER BY gain DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
        f"factors AS (SELECT max(({budget} - full_tokens) / open_weight) FILTER (({budget} - full_tokens) / open_weight * gain <= 1) AS factor FROM above)",
        f"chances AS MATERIALIZED (SELECT {dims}, least(1.0, gain * coalesce((SELECT factor FROM factors), 1e300)) AS probability FROM gains)",
    ]
    on = " AND ".join(f"c.{n} = coalesce('=' || d.{n}, 'null')" for n in POWERS)
    return ("WITH " + ",\n".join(parts) + "\nSELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(c.probability, 6) AS probability, "
            "('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < c.probability AS sampled "
            f"FROM docs d JOIN chances c ON {on}")


SQL = _sql()
