"""Mixing sources to target weights: raking, DataFrame operations only.

Documents fall into cells (source, language, topic). Cell weights start at the
cell's words and are scaled to the target share of each source, then each
language, then each topic, round after round (iterative proportional fitting).
No cell gives more words than it has: a cell whose chance reaches 1 is taken
whole, and each scaling step solves for the factor at which the others make up
for it (``capped``), until every marginal is met within ``TOLERANCE``. A target
above the words of its value cannot be reached; the value is taken whole, the
rest of its target goes to the other values by their shares, and
``reached_shares`` tells target and reached share. A document of a cell is taken
with the chance of its cell, decided by a hash of its id, so a rerun takes the
same documents.

Marginals that can be met one by one may still not be met together; then the
rounds run out, a warning says how many words are astray, and ``reached_shares``
shows where.

Sums are partial aggregates, so a source with a third of all rows is no hot
spot; the cell table never leaves Spark, and each round is written to the
shared folder.

Targets are shares per value of a dimension; where none are given they are
the value's words to the power ``flatten`` (below 1: large sources are damped).

Defined cases: null source or language is a value of its own; null or empty
text has no words and the topic ``general``; a cell without any word has
probability 0; a null ``doc_id`` is decided by
the hash of the text; repeated rows get the same decision; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store, text_of

DIMENSIONS = ("source", "lang", "topic")
#: Literal markers by topic; the topic whose markers a text holds most often wins.
TOPICS = {"legal": ("icense", "opyright", "CC BY"), "contact": ("@", "+1", "phone"), "tables": (" | ", "\t"),
          "markup": ("***", "%%%", "&&&", "###"), "quoted": ("!!", "??")}
FLATTEN, BUDGET, SEED, CELL_BOUND = 0.7, 0.6, 17, 50_000
#: Of the capped raking: largest error of a marginal, as a share of the budget, and rounds after which it stops in any case.
TOLERANCE, MOST_ROUNDS = 1e-6, 60


def topic_of(text: Column) -> Column:
    def held(markers):
        return reduce(lambda a, b: a + b, (F.floor((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(m), F.lit("")))) / F.lit(len(m))) for m in markers))

    counts = [held(m) for m in TOPICS.values()]
    most = F.greatest(*counts)
    found = F.when(most == 0, "general")
    for name, n in zip(TOPICS, counts, strict=True):
        found = found.when(n == most, name)
    return found


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def chance(doc_id: Column, text: Column, seed: int) -> Column:
    """Uniform in [0, 1), 52 bits of a hash of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), text)))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_words").alias("words"))


def target_shares(cells: DataFrame, dim: str, flatten: float) -> DataFrame:
    part = cells.groupBy(dim).agg(F.pow(F.sum("words").cast("double"), F.lit(flatten)).alias("part"))
    whole = part.agg(F.sum("part").alias("whole")).first()["whole"] or 1.0      # one number
    return part.select(dim, (F.col("part") / F.lit(whole)).alias("share"))


def _same(a: DataFrame, b: DataFrame, names) -> Column:
    return reduce(lambda x, y: x & y, (a[n].eqNullSafe(b[n]) for n in names))


def _scaled(rows: DataFrame, by: list[str], aim: Column, order: tuple[str, ...]) -> DataFrame:
    """``ratio`` times the factor at which ``words * min(1, ratio)`` sums to ``aim`` over each ``by``."""
    part = Window.partitionBy(*by)
    falling = part.orderBy(F.desc("ratio"), *order)
    above = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)).cast("double"), F.lit(0.0))
    rest = F.sum(F.col("words") * F.col("ratio")).over(falling.rowsBetween(0, Window.unboundedFollowing))
    # with the larger ratios taken whole; the factor is the largest that leaves this row at 1 or below
    rows = rows.withColumn("_aim", aim).withColumn("_factor", (F.col("_aim") - above) / F.nullif(rest, F.lit(0.0)))
    fits = F.max(F.when(F.col("_factor") * F.col("ratio") <= 1, F.greatest("_factor", F.lit(0.0)))).over(part)
    whole = 1 / F.min(F.when(F.col("ratio") > 0, F.col("ratio"))).over(part)
    factor = F.when(F.col("_aim") >= F.sum("words").over(part), whole).otherwise(F.coalesce(fits, whole))
    grown = F.col("ratio") * F.coalesce(factor, F.lit(0.0))
    # far beyond any chance that matters, but within a double
    return rows.withColumn("ratio", F.when(grown > 0, F.least(F.greatest(grown, F.lit(1e-100)), F.lit(1e100))).otherwise(0.0)).drop("_aim", "_factor")


def _marginals(now: DataFrame) -> DataFrame:
    """``dim, value, target, reachable, reached`` in words."""
    sides = [F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value"), F.col(f"to_{d}").alias("target"), F.col(f"aim_{d}").alias("reachable"),
                      (F.col("words") * F.least(F.lit(1.0), F.col("ratio"))).alias("reached")) for d in DIMENSIONS]
    return now.select(F.explode(F.array(*sides)).alias("m")).select("m.*").groupBy("dim", "value").agg(
        F.first("target").alias("target"), F.first("reachable").alias("reachable"), F.sum("reached").alias("reached"))


def capped(cells: DataFrame, budget: float = BUDGET, targets: dict[str, DataFrame] | None = None, rounds: int = MOST_ROUNDS,
           flatten: float = FLATTEN, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells(source, lang, topic, words)`` with ``ratio``, whose chance is
    ``min(1, ratio)``, and for each dimension the words wanted (``to_``) and
    those that can be had (``aim_``)."""
    cells = cells.where("words > 0")
    whole = cells.agg(F.sum("words").alias("n")).first()["n"] or 0      # one number
    wanted = min(budget, 1.0) * whole
    now = cells.withColumn("ratio", F.lit(1.0))
    for dim in DIMENSIONS:
        share = (targets or {}).get(dim)
        share = target_shares(cells, dim, flatten) if share is None else share
        share = share.select(F.col(dim).alias("value"), F.col("share"))
        held = cells.groupBy(dim).agg(F.sum("words").alias("words"))
        held = held.join(share, held[dim].eqNullSafe(share["value"]), "left").drop("value")
        held = held.withColumn("share", F.coalesce("share", F.lit(0.0)).cast("double")).withColumn("ratio", F.col("share") / F.col("words"))
        held = _scaled(held, [], F.lit(wanted), (dim,))
        side = held.select(F.col(dim).alias("value"), (F.col("share") * F.lit(wanted)).alias(f"to_{dim}"),
                           (F.col("words") * F.least(F.lit(1.0), F.col("ratio"))).alias(f"aim_{dim}"))
        now = now.join(side, now[dim].eqNullSafe(side["value"])).drop("value")
    now = store(now, "cells")
    for _ in range(rounds):
        for dim in DIMENSIONS:
            now = _scaled(now, [dim], F.col(f"aim_{dim}"), DIMENSIONS)
        now = store(now, "cells")
        error = _marginals(now).agg(F.max(F.abs(F.col("reached") - F.col("reachable"))).alias("n")).first()["n"] or 0.0      # one number
        if error <= tolerance * wanted:
            break
    else:
        warnings.warn(f"raking stopped after {rounds} rounds with {error:.6g} words of {wanted:.6g} astray; see reached_shares", stacklevel=2)
    return now


def reached_shares(cells: DataFrame, budget: float = BUDGET, **raking) -> DataFrame:
    """``dim, value, target, reachable, reached``: shares of the budget that
    were asked for, that the words of the value allow, and that are expected."""
    found = _marginals(capped(cells, budget, **raking))
    whole = cells.agg(F.sum("words").alias("n")).first()["n"] or 1      # one number
    return found.select("dim", "value", *((F.col(c) / F.lit(min(budget, 1.0) * whole)).alias(c) for c in ("target", "reachable", "reached")))


def capped_probabilities(cells: DataFrame, budget: float = BUDGET, **raking) -> DataFrame:
    """``(source, lang, topic, p)``: the chance of a document of the cell."""
    return capped(cells, budget, **raking).select(*DIMENSIONS, F.round(F.least(F.lit(1.0), F.col("ratio")), 9).alias("p"))


def with_probability(rows: DataFrame, p: DataFrame) -> DataFrame:
    """Adds ``p``. The cells are broadcast up to ``CELL_BOUND`` of them; beyond
    that Spark joins by cell and splits the hot ones."""
    p = store(p, "chances")
    side = p.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), F.col("p").alias("_p"))
    side = F.broadcast(side) if p.count() <= CELL_BOUND else side
    same = reduce(lambda x, y: x & y, (rows[d].eqNullSafe(side[f"_{d}"]) for d in DIMENSIONS))
    return rows.join(side, same, "left").withColumn("p", F.coalesce("_p", F.lit(0.0))).drop("_p", *(f"_{d}" for d in DIMENSIONS))


def mixture(docs: DataFrame, budget: float = BUDGET, seed: int = SEED, **raking) -> DataFrame:
    """One row per document: ``doc_id, source, lang, topic, n_words, p, selected``."""
    text = text_of()
    rows = store(docs.select("doc_id", "source", "lang", topic_of(text).alias("topic"), words_in(text).alias("n_words"), chance(F.col("doc_id"), text, seed).alias("u")), "mix")
    out = with_probability(rows, capped_probabilities(cells_of(rows), budget, **raking))
    return out.select("doc_id", *DIMENSIONS, "n_words", "p", (F.col("u") < F.col("p")).alias("selected"))


def sampled_documents(docs: DataFrame, budget: float = BUDGET, seed: int = SEED, **raking) -> DataFrame:
    """The documents that the mixture takes, with their own columns only."""
    text, names = text_of(), docs.columns
    rows = docs.select(F.struct(*(docs[c] for c in names)).alias("_row"), "source", "lang", topic_of(text).alias("topic"),
                       words_in(text).alias("n_words"), chance(F.col("doc_id"), text, seed).alias("_u"))
    cells = store(cells_of(rows), "cells")
    return with_probability(rows, capped_probabilities(cells, budget, **raking)).where("_u < p").select("_row.*")
