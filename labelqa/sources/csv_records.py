"""Records of quoted CSV files, read by many tasks per file.

A quoted field may hold line ends, so a task that starts in the middle of a
file cannot tell by itself whether it starts inside a field; Spark's
``multiLine`` reader therefore gives a whole file to one task. Here files are
split as text is, in two passes:

1. every split counts its quotes and says where its last record begins, for
   both cases (it starts outside, it starts inside a field);
2. a prefix over the splits of a file (one row per split) tells which case
   holds and, for a split that starts inside, which record it continues.

A task then cuts its lines into records. A record that crosses a split's end
leaves in pieces, which are joined by its position; all others are whole where
they are. Doubled quotes inside a field keep the count right (RFC 4180); a
quote inside an unquoted field is malformed, as is a field without its closing
quote at the end of a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable

_PIECE = "file string, pos long, part long, text string, whole boolean"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, value``: lines in file order within each split."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))


def _runs(batches) -> Iterator[tuple[str, int, pa.StringArray]]:
    """``(file, start, lines)`` for stretches of one split, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1)
        at = start.to_numpy(zero_copy_only=False)
        name = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edge = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(name, prepend=-1) != 0))
        for a, b in zip(edge, np.append(edge[1:], len(at)), strict=True):
            yield file[int(a)].as_py(), int(at[a]), batch.column(2).slice(int(a), int(b - a))


def _open_before(lines: pa.StringArray, inside: int) -> tuple[np.ndarray, int]:
    """For each line: does it begin inside a field? And the state after the last."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    state = (np.cumsum(quotes) + inside) & 1
    return np.concatenate([[inside], state[:-1]]).astype(bool), int(state[-1])


def _summary(batches):
    """Per split: odd number of quotes?, line of the last record start if it
    begins outside, if it begins inside (null: none starts here)."""
    names = ["file", "start", "odd", "last0", "last1"]
    key, odd, count, last = None, 0, 0, [None, None]

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, bool(odd), *last), strict=True))],
                                          schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("odd", pa.bool_()), ("last0", pa.int64()), ("last1", pa.int64())]))

    for file, start, lines in _runs(batches):
        if (file, start) != key:
            if key is not None:
                yield row()
            key, odd, count, last = (file, start), 0, 0, [None, None]
        before, after = _open_before(lines, odd)
        for case in (0, 1):
            begins = np.flatnonzero(before == bool(case))
            if len(begins):
                last[case] = count + int(begins[-1])
        odd, count = after, count + len(lines)
    if key is not None:
        yield row()


def _pieces(owner_of):
    """Lines of a split -> records ``file, pos, part, text, whole``. ``pos`` is
    the split's offset plus the record's line in it: unique and in file order."""
    schema = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("whole", pa.bool_())])

    def cut(batches):
        key, state, count, held, pos, whole = None, 0, 0, [], None, True

        def flush(ends_here):
            text = "\n".join(held)
            return {"file": key[0], "pos": pos, "part": key[1], "text": text, "whole": whole and ends_here}

        for file, start, lines in _runs(batches):
            out = []
            if (file, start) != key:
                if held:
                    out.append(flush(state == 0))
                key, count, held = (file, start), 0, []
                state = int((file, start) in owner_of.value)
                pos, whole = (owner_of.value[(file, start)], False) if state else (None, True)
            before, after = _open_before(lines, state)
            for inside, line in zip(before.tolist(), lines.to_pylist(), strict=True):
                if not inside:
                    if held:
                        out.append(flush(True))
                    held, pos, whole = [], start + count, True
                held.append(line)
                count += 1
            state = after
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([flush(state == 0)], schema=schema)

    return cut


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, pos, text`` of every CSV record (the header included, with pos 0)."""
    lines = text_lines(spark, path)
    splits = durable(lines.mapInArrow(_summary, "file string, start long, odd boolean, last0 long, last1 long"), "splits")
    order = Window.partitionBy("file").orderBy("start")
    quotes = F.coalesce(F.sum(F.col("odd").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("inside", quotes % 2 == 1)
    began = F.col("start") + F.when(F.col("inside"), F.col("last1")).otherwise(F.col("last0"))
    splits = splits.withColumn("began", began).withColumn(
        "owner", F.last("began", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    # one row per split that starts inside a field: at most one in 128 MB of input
    crossing = {(r["file"], r["start"]): r["owner"] for r in splits.where("inside").select("file", "start", "owner").toLocalIterator()}
    owner = spark.sparkContext.broadcast(crossing)
    pieces = lines.mapInArrow(_pieces(owner), _PIECE)
    whole = pieces.where("whole").select("file", "pos", "text")
    if not crossing:
        return pieces.select("file", "pos", "text")
    broken = pieces.where("not whole").groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("parts"))
    broken = broken.select("file", "pos", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    return whole.union(broken)


def read_csv(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """Typed rows of headed CSV files with ``file`` and ``pos`` (file order)."""
    rows = records(spark, path).where("pos > 0")
    text = F.regexp_replace("text", "\r$", "")
    rows = rows.select("file", "pos", text.alias("text")).where("text <> ''")
    options = {"escape": '"', "mode": mode, "multiLine": "true"}
    return rows.select("file", "pos", F.from_csv("text", schema, options).alias("r")).select("file", "pos", "r.*")
