"""Prefix trie of conversations: count-min screening of prefix digests.

A prefix is known by a digest of its turns: running sums of two 60-bit hashes
of (position, turn), so the digest of a long conversation comes from chunks
and no task needs the whole of it. Texts do not travel: a turn is its MD5.

All prefix digests go into a count-min sketch. An estimate of one proves that
a single conversation has the prefix, so that node and those below it are that
conversation's own: they are emitted where they stand. Only prefixes that may
be shared (a few of them singletons by collision) are grouped exactly, behind
partial aggregates. What a node needs of its subtree is a sum over its members:
the smallest member of a prefix is also the smallest of every longer prefix of
its own, so each conversation adds up the nodes that it stands for, along its
own path, and the sums are aggregated by prefix.

Collisions of the sketch cost rows in a shuffle and change nothing; its width
follows the number of prefixes up to a fixed bound. The digest has 120 bits.

Defined cases: null role or text is empty; null turn comes first; equal turn
numbers are ordered by the MD5 of role and text; repeated rows are turns of
their own; rows without a conversation id belong to none; an empty table has
no conversations and so no root; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store
from .count_min import cells, counters, width_for

CHUNK = 4096
SKETCH_ROWS = 4
LANE = 1 << 62
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_marks(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, mark, words``: each turn as a digest, without its text."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    mark = F.md5(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said))
    return rows.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), mark.alias("mark"),
                                                      F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"))


def numbered(marks: DataFrame) -> DataFrame:
    """``conv, pos, mark, words``: turns numbered from 0. Range partitions are
    written once; a long conversation spans several of them."""
    n = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = store(marks.repartitionByRange(n, "conv", "turn", "mark").withColumn("part", F.spark_partition_id()), "turns")
    within = Window.partitionBy("conv", "part").orderBy("turn", "mark")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv", "part").agg(F.count("*").alias("n")).select("conv", "part", F.sum("n").over(earlier).alias("before"))
    rows = rows.withColumn("pos", F.row_number().over(within)).join(before.where("before > 0"), ["conv", "part"], "left")
    return rows.select("conv", (F.col("pos") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "mark", "words")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first turns of another one.

    ``conv`` takes the first ``h`` turns of ``conv - conv % every`` and its own
    after the first ``h``, ``h = crc32(conv) % most``. Returns
    ``(conv, depth, mark, words)`` with depth from 1, and ``(conv)`` for all.
    """
    size = turns.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    convs = size.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), h.alias("h"))
    bases = size.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("n").alias("has"))
    convs = convs.join(bases, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    heads = turns.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv", "base")
    opening = convs.join(heads, "base").where("pos < h").select("conv", (F.col("pos") + 1).alias("depth"), "mark", "words")
    own = turns.join(convs, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "mark", "words")
    return opening.union(own), size.select("conv")


def _chunk(depth: str = "depth") -> Column:
    return F.floor((F.greatest(F.col(depth), F.lit(1)) - 1) / CHUNK)


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, k1, k2, p1, p2, words, last``: every prefix with its own
    digest (k) and that of the prefix before it (p)."""
    hashed = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "mark"))
    lanes = [F.conv(F.substring(hashed, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    rows = turns.select("conv", "depth", "words", lanes[0].alias("t1"), lanes[1].alias("t2"), _chunk().alias("chunk"))
    here = Window.partitionBy("conv", "chunk").orderBy("depth")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    full = rows.groupBy("conv", "chunk").agg(F.sum("t1").cast("decimal(38,0)").alias("c1"), F.sum("t2").cast("decimal(38,0)").alias("c2"), F.count("*").alias("n"))
    full = full.where((F.col("chunk") > 0) | (F.col("n") == CHUNK))
    full = full.select("conv", "chunk", F.sum("c1").over(earlier).alias("c1"), F.sum("c2").over(earlier).alias("c2"),
                       F.lead("chunk").over(Window.partitionBy("conv").orderBy("chunk")).isNotNull().alias("more"))
    rows = rows.select("*", F.sum("t1").over(upto).alias("s1"), F.sum("t2").over(upto).alias("s2"), F.lead("depth").over(here).alias("next"))
    rows = rows.join(full, ["conv", "chunk"], "left")
    zero = F.lit(0).cast("decimal(38,0)")
    sums = {i: F.col(f"s{i}") + F.coalesce(F.col(f"c{i}"), zero) for i in (1, 2)}
    lane = lambda total: F.pmod(total.cast("decimal(38,0)"), F.lit(LANE).cast("decimal(38,0)")).cast("long")
    return rows.select("conv", "depth", lane(sums[1]).alias("k1"), lane(sums[2]).alias("k2"), lane(sums[1] - F.col("t1")).alias("p1"), lane(sums[2] - F.col("t2")).alias("p2"),
                       "words", (F.col("next").isNull() & ~F.coalesce("more", F.lit(False))).alias("last"))


def _twice(counts: np.ndarray) -> np.ndarray:
    return np.packbits(counts > 1)


def screen(rows: DataFrame, most_width: int = 1 << 24):
    """A column function: may the digest belong to more than one row?"""
    width = width_for(rows.count(), 1 / 8, most=most_width)
    bits = counters(rows.select(F.xxhash64("k1", "k2")), width, SKETCH_ROWS, _twice)
    seen = rows.sparkSession.sparkContext.broadcast(bits)   # width * SKETCH_ROWS / 8 bytes: 8 MB at most

    @F.arrow_udf("boolean")
    def shared(keys: pa.Array) -> pa.Array:
        found, table = keys.to_numpy(zero_copy_only=False), seen.value
        out = np.ones(len(found), bool)
        for row in range(SKETCH_ROWS):
            at = cells(found, width, row) + row * width
            out &= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return pa.array(out)

    return lambda a, b: shared(F.xxhash64(a, b))


def _id_texts(size: int = 1 << 16):
    """Rows (k1, k2, conv) in order -> one comma-joined text per run of up to ``size`` bytes."""
    def joined(batches):
        key, first, held, n = None, None, [], 0
        for batch in batches:
            a, b, c = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for k1, k2, conv in zip(a, b, c, strict=True):
                if (k1, k2) != key or n > size:
                    if held:
                        out.append((*key, first, ",".join(held)))
                    key, first, held, n = (k1, k2), conv, [], 0
                held.append(str(conv))
                n += len(held[-1]) + 1
            yield _batch(out, ["k1", "k2", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])
        if held:
            yield _batch([(*key, first, ",".join(held))], ["k1", "k2", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])
    return joined


def _batch(rows, names, types):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _digests(batches):
    """Texts in order of (k1, k2, first) -> SHA-256 of each key's texts, as a stream."""
    key, run = None, None
    names, types = ["k1", "k2", "sha"], [pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        a, b, c = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
        out = []
        for k1, k2, ids in zip(a, b, c, strict=True):
            if (k1, k2) != key:
                if key is not None:
                    out.append((*key, run.hexdigest()))
                key, run = (k1, k2), hashlib.sha256(ids.encode())
            else:
                run.update(b"," + ids.encode())
        yield _batch(out, names, types)
    if key is not None:
        yield _batch([(*key, run.hexdigest())], names, types)


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends(k1, k2, conv)`` -> SHA-256 over each key's ascending ids. The ids
    of a hot key are joined to texts in many range partitions; only the hash
    itself, which is sequential, reads them in one place, as a stream."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = ends.repartitionByRange(n, "k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv")
    texts = texts.mapInArrow(_id_texts(), "k1 long, k2 long, first long, ids string")
    return texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(_digests, "k1 long, k2 long, sha string")


def prefix_trie(turns: DataFrame, members: DataFrame, most_width: int = 1 << 24) -> DataFrame:
    """Nodes of the trie over ``turns(conv, depth, mark, words)``, depth dense
    from 1; ``members(conv)`` also lists conversations without turns."""
    rows = store(prefixes(turns), "prefixes")
    may = screen(rows, most_width)
    flags = rows.select("*", may("k1", "k2").alias("shared"), (may("p1", "p2") | (F.col("depth") == 1)).alias("under"))
    flags = store(flags, "screened")
    # proven singletons below a proven singleton: nothing else is needed
    own_end = F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(NOTHING))
    one = F.lit(1).cast("long")
    kids = F.when(F.col("last"), 0).otherwise(1).cast("long")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    tails = flags.where("not shared and not under").select("conv", "depth", "conv", one, kids, one, F.lit(0).cast("long"), own_end).toDF(*names)
    # prefixes that may be shared: exact groups
    maybe = flags.where("shared")
    groups = maybe.groupBy("k1", "k2").agg(F.min("conv").alias("rep"), F.count("*").alias("n"), F.count_if("last").alias("ends"))
    met = maybe.select("k1", "k2", "conv", "depth", "words", "last").join(groups, ["k1", "k2"])
    met = met.select("k1", "k2", "conv", "depth", "words", "last", "rep", "n", "ends", F.lit(False).alias("top"))
    tops = flags.where("not shared and under").select("k1", "k2", "conv", "depth", "words", "last", F.col("conv").alias("rep"), F.lit(1).cast("long").alias("n"),
                                                      F.lit(1).cast("long").alias("ends"), F.lit(True).alias("top"))
    # the root: three numbers instead of a group of all conversations
    bare = members.join(turns.where("depth = 1").select("conv"), "conv", "left_anti").select("conv", F.lit(True).alias("last"))
    began = turns.where("depth = 1").select("conv", F.lit(False).alias("last"))
    everyone = store(bare.union(began), "members")
    whole = everyone.agg(F.min("conv").alias("rep"), F.count("*").alias("n"), F.count_if("last").alias("ends")).first()
    zero = F.lit(0).cast("long")
    root = everyone.select(zero.alias("k1"), zero.alias("k2"), "conv", zero.alias("depth"), zero.alias("words"), "last", F.lit(whole["rep"]).cast("long").alias("rep"),
                           F.lit(whole["n"]).cast("long").alias("n"), F.lit(whole["ends"]).cast("long").alias("ends"), F.lit(False).alias("top"))
    path = met.union(tops).union(root).withColumn("chunk", _chunk())
    path = store(_along(path), "paths")
    tops = path.where("top").select("conv", "depth", "parent", one, kids, one, zero, own_end).toDF(*names)
    nodes = path.where("not top").groupBy("k1", "k2").agg(
        F.min("rep").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent_conv_id"), F.min("n").alias("n_convs"), F.sum("child").alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.min("ends").alias("ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("end"))
    many = end_digests(path.where("not top and last and ends > 1").select("k1", "k2", "conv"))
    sha = F.when(F.col("ends") == 0, F.lit(NOTHING)).when(F.col("ends") == 1, F.sha2(F.col("end").cast("string"), 256)).otherwise(F.col("sha"))
    nodes = nodes.join(many, ["k1", "k2"], "left").withColumn("ends_sha256", sha).select(*names)
    return nodes.union(tops).union(tails)


def _along(path: DataFrame) -> DataFrame:
    """Per row of a conversation's path: the parent's representative, whether
    the next node is its own, and its share of the subtree's sums."""
    path = path.withColumn("mine", F.col("rep") == F.col("conv"))
    cost = F.when(F.col("mine"), (F.col("n") - 1) * F.col("words")).otherwise(0).cast("long")
    leaf = (F.col("mine") & (F.col("top") | (F.col("last") & (F.col("ends") == F.col("n"))))).cast("long")
    path = path.select("*", cost.alias("cost"), leaf.alias("is_leaf"))
    here = Window.partitionBy("conv", "chunk").orderBy("depth")
    on = here.rowsBetween(0, Window.unboundedFollowing)
    rows = path.select("*", F.lag("rep").over(here).alias("before"), F.lead("mine").over(here).alias("after"),
                       F.sum("cost").over(on).alias("sum_on"), F.max("is_leaf").over(on).alias("leaf_on"))
    by = Window.partitionBy("conv").orderBy("chunk")
    later = by.rowsBetween(1, Window.unboundedFollowing)
    chunks = path.groupBy("conv", "chunk").agg(F.max_by("rep", "depth").alias("end_rep"), F.min_by("mine", "depth").alias("start"), F.sum("cost").alias("c"), F.max("is_leaf").alias("l"))
    chunks = chunks.select("conv", "chunk", F.lag("end_rep").over(by).alias("c_before"), F.lead("start").over(by).alias("c_after"), F.sum("c").over(later).alias("c_sum"),
                           F.max("l").over(later).alias("c_leaf"))
    rows = rows.join(chunks.where("c_before is not null or c_after is not null"), ["conv", "chunk"], "left")
    return rows.select("k1", "k2", "conv", "depth", "last", "rep", "n", "ends", "top",
                       F.coalesce("before", "c_before").alias("parent"), F.coalesce("after", "c_after", F.lit(False)).cast("long").alias("child"),
                       (F.col("sum_on") + F.coalesce("c_sum", F.lit(0))).alias("saved"), F.greatest("leaf_on", F.coalesce("c_leaf", F.lit(0))).alias("leaf"))
