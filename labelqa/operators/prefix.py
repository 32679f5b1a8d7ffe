"""Skew-safe running (prefix) sums per group.

A window ``partitionBy(doc).orderBy(seq)`` sends every row of a document to
one task; a document holding a third of all rows would stall the job. Here
rows are cut into chunks of at most ``chunk`` consecutive ``seq`` values:

1. within-chunk running sums: window over ``(doc, chunk)`` (bounded size);
2. chunk totals: hash aggregate on ``(doc, chunk)`` (partial + final);
3. chunk offsets and group totals: a window over the chunk table, which is
   ``chunk`` times smaller than the input;
4. offsets joined back on ``(doc, chunk)``, a key that cannot be hot.

``seq`` must be unique within a group. Dense integers (the usual image order)
are chunked by value (``seq // chunk``); sparse integers and any other
orderable ``seq`` (a string, a struct of keys) are sorted into range partitions
and stored with the partition as their chunk, so both branches below read the
same assignment. Rows of a null group or null ``seq`` are kept (nulls first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable

DEFAULT_CHUNK = 4096


def running_sums(df: DataFrame, by: str, seq: str, values: list[str],
                 chunk: int = DEFAULT_CHUNK, totals: dict | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Add ``<v>_before`` (sum over earlier rows, 0 for the first) per value,
    ``rank_before`` (count of earlier rows) and group totals.

    ``totals`` maps output name -> (agg, column) with agg in {"sum", "max",
    "count"} ("count" counts rows, null or not); they are computed from chunk partials, never from all rows of
    a group in one task.
    """
    totals = totals or {}
    if _dense(df, by, seq):
        ck = F.floor(F.col(seq) / F.lit(chunk))
    else:
        # stored once: a range exchange planned twice would sample its bounds twice
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = durable(df.repartitionByRange(n, by, seq).withColumn("__range", F.spark_partition_id()), "ranges")
        ck = F.col("__range")
    ck = ck.alias("_chunk")
    rows = df.select("*", ck)
    w_in = (Window.partitionBy(by, "_chunk").orderBy(seq)
            .rowsBetween(Window.unboundedPreceding, -1))
    inner = rows.select(
        "*",
        *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"_{v}_in") for v in values],
        F.coalesce(F.count(F.lit(1)).over(w_in), F.lit(0)).alias("_n_in"),
    )
    partial = []
    for name, (agg, col) in totals.items():
        fn = {"sum": F.sum, "max": F.max, "count": lambda _: F.count(F.lit(1))}[agg]
        partial.append(fn(col).alias(f"_t_{name}"))
    # chunk totals straight from the rows: map-side partial aggregation, so
    # this shuffle carries one partial row per (task, group, chunk), not rows
    chunks = rows.groupBy(by, "_chunk").agg(
        *[F.sum(v).alias(f"_{v}_c") for v in values],
        F.count(F.lit(1)).alias("_n_c"), *partial)
    w_c = Window.partitionBy(by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(by)
    merge = {"sum": F.sum, "max": F.max, "count": F.sum}
    offs = chunks.select(
        by, "_chunk",
        *[F.coalesce(F.sum(f"_{v}_c").over(w_c), F.lit(0)).alias(f"_{v}_off") for v in values],
        F.coalesce(F.sum("_n_c").over(w_c), F.lit(0)).alias("_n_off"),
        *[merge[agg](f"_t_{name}").over(w_all).alias(name) for name, (agg, _) in totals.items()],
    )
    offs = offs.withColumnRenamed(by, "__by").withColumnRenamed("_chunk", "__chunk")
    out = inner.join(offs, inner[by].eqNullSafe(offs["__by"]) & inner["_chunk"].eqNullSafe(offs["__chunk"]), "inner")
    extra = [(F.col(f"_{v}_in") + F.col(f"_{v}_off")).alias(f"{v}_before") for v in values]
    extra.append((F.col("_n_in") + F.col("_n_off")).alias("rank_before"))
    keep = [c for c in df.columns if c != "__range"]
    return out.select(*keep, *extra, *totals.keys())


def _dense(df: DataFrame, by: str, seq: str, spare: int = 16) -> bool:
    """Is ``seq`` an integer that takes a fair part of the values it spans, in
    every group? Then chunks by value hold rows in proportion to their number."""
    if not isinstance(df.schema[seq].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return False
    span = df.groupBy(by).agg(((F.max(seq).cast("double") - F.min(seq).cast("double") + 1) / F.count(F.lit(1))).alias("x"))
    widest = span.agg(F.max("x").alias("x")).first()["x"]
    return widest is None or widest <= spare


def rank_within(df: DataFrame, by: str, order: str, partitions: int | None = None) -> DataFrame:
    """1-based rank of ``order`` (any sortable type, unique per group) within
    ``by``; no task ever holds a whole group (see ``running_sums``)."""
    r = running_sums(df, by, order, [], partitions=partitions)
    return r.withColumn("rank", F.col("rank_before") + 1).drop("rank_before")
