"""SimHash near duplicates: tiled exact comparison of 64-bit fingerprints.

Equal fingerprints fall together in a partial aggregate first, so a group of
copies of any size is one node. Four 16-bit blocks (radius + 2 in general)
make two fingerprints within the radius agree on at least two blocks, so only
fingerprints that share two blocks can link: that is one shuffle group per
(pair of blocks, their value). Inside a group the fingerprints stand in order
of population count, in tiles; two tiles are compared with exclusive-or and
bit counts, and skipped when their counts differ by more than the radius.
A group larger than ``tile`` is dealt out as pairs of tiles, each its own task
group. A tile pair returns a spanning star of its links, never all pairs, and
the components of the stars are those of all links.

Nothing is sampled, capped or skipped: the result is the exact set of
components.

Defined cases: null text is the empty text; texts without words have
fingerprint zero and link like any other; a null ``doc_id`` takes part, and a
component id is the smallest non-null id (null if there is none); repeated
rows are repeated in the result; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_of
from .components import components

SEED = 42
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
SLICE = 1 << 18


def simhash(raw: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:]
    total = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):       # bounded memory for very long texts
        cut = slice(at, min(n, at + SLICE))
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(text[a:b], SEED) for a, b in zip(starts[cut].tolist(), ends[cut].tolist(), strict=True)])
        lanes = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        total += np.concatenate([np.bincount(lanes[:, k], minlength=256) @ BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t or b"", shingle) for t in texts.to_pylist()], pa.int64())

    return fp(text.cast("binary"))


def _roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees of a[i] and b[i]; a root is the smallest index."""
    while True:
        x, y = parent[a], parent[b]
        if not (x != y).any():
            return parent
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up


def tile_links(fps: np.ndarray, radius: int, side: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of the links among ``fps`` (uint64, distinct)."""
    ones = np.bitwise_count(fps)
    order = np.argsort(ones, kind="stable")
    fps, ones = fps[order], ones[order].astype(np.int16)
    parent = np.arange(len(fps))
    for i in range(0, len(fps), side):
        x = fps[i:i + side]
        for j in range(i, len(fps), side):
            if ones[j] - ones[min(i + side, len(fps)) - 1] > radius:
                break                   # counts only rise from here on
            near = np.bitwise_count(x[:, None] ^ fps[None, j:j + side]) <= radius
            a, b = np.nonzero(near)
            a, b = a + i, b + j
            apart = parent[a] != parent[b]
            if apart.any():
                parent = _roots(parent, a[apart], b[apart])
    tied = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[tied], fps[parent[tied]]


def _compare(radius: int, small: int = 24):
    def links(batches):
        """Rows (grp, fp) in order of grp; at most one group is carried on."""
        held_g, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)
        out_a, out_b = [], []

        def group_links(g, f):
            edges = np.flatnonzero(np.diff(g, prepend=g[0] - 1)) if len(g) else np.empty(0, np.int64)
            sizes = np.diff(edges, append=len(g))
            top = int(sizes[sizes <= small].max(initial=0))
            wide = np.repeat(sizes > small, sizes)
            for d in range(1, top):     # groups of a few rows, all at once
                hit = (g[d:] == g[:-d]) & ~wide[d:]
                at = np.flatnonzero(hit)
                at = at[np.bitwise_count(f[at + d] ^ f[at]) <= radius]
                out_a.append(f[at + d])
                out_b.append(f[at])
            for e, n in zip(edges[sizes > small], sizes[sizes > small], strict=True):
                a, b = tile_links(np.unique(f[e:e + n]), radius)
                out_a.append(a)
                out_b.append(b)

        def made():
            a = np.concatenate(out_a).view(np.int64) if out_a else np.empty(0, np.int64)
            b = np.concatenate(out_b).view(np.int64) if out_b else np.empty(0, np.int64)
            out_a.clear()
            out_b.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            g = np.concatenate([held_g, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([held_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(g):
                continue
            last = int(np.searchsorted(g, g[-1], "left"))
            group_links(g[:last], f[:last])
            held_g, held_f = g[last:], f[last:]
            yield made()
        group_links(held_g, held_f)
        yield made()

    return links


def links(nodes: DataFrame, radius: int = 2, tile: int = 4096) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints linked within
    ``radius`` bits. ``nodes(fp)`` holds distinct, null-free fingerprints."""
    blocks = radius + 2
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    block = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    keys = F.array(*(F.xxhash64(F.lit(i), F.lit(j), block[i], block[j]) for i, j in combinations(range(blocks), 2)))
    rows = nodes.select("fp", F.bit_count("fp").alias("ones"), F.explode(keys).alias("grp"))
    size = rows.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(size, "grp")
    cool = rows.where(F.col("n") <= tile).select("grp", "fp", "ones")
    # larger groups: tiles of one population count, and the pairs of tiles that may link
    hot = rows.where(F.col("n") > tile)
    many = hot.groupBy("grp", "ones").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("m"))
    tiles = many.select("grp", "ones", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("slot"))
    other = tiles.select("grp", F.col("ones").alias("ones2"), F.col("slot").alias("slot2"))
    pairs = tiles.join(other, "grp").where(
        F.col("ones2").between(F.col("ones"), F.col("ones") + radius) & ((F.col("ones") < F.col("ones2")) | (F.col("slot") <= F.col("slot2"))))
    pairs = pairs.withColumn("task", F.xxhash64("grp", "ones", "slot", "ones2", "slot2"))
    ends = pairs.select("grp", "task", "ones", "slot").union(pairs.select("grp", "task", F.col("ones2"), F.col("slot2"))).distinct()
    placed = hot.join(many, ["grp", "ones"]).withColumn("slot", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    dealt = placed.join(ends, ["grp", "ones", "slot"]).select(F.col("task").alias("grp"), "fp", "ones")
    groups = cool.union(dealt).repartition("grp").sortWithinPartitions("grp", "ones").select("grp", "fp")
    return groups.mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, tile: int = 4096) -> DataFrame:
    """One row per document: ``id, fp, component_id``."""
    rows = store(docs.select(F.col(id_col).alias("id"), fingerprint(text_of(text_col), shingle).alias("fp")), "fingerprints")
    return rows.join(component_labels(rows, radius, tile), "fp").select("id", "fp", "component_id")


def component_labels(rows: DataFrame, radius: int, tile: int = 4096) -> DataFrame:
    """``rows(id, fp)`` -> ``(fp, component_id)``, one row per fingerprint."""
    nodes = store(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = components(links(nodes.select("fp"), radius, tile)).select(F.col("node").alias("fp"), "root")
    nodes = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return nodes.join(least, "root").select("fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents with one row of each component: the smallest ``doc_id``
    (null last), then the smallest text hash. All columns as they came."""
    mark = F.xxhash64(text_of())
    rows = store(docs.select(F.col("doc_id").alias("id"), mark.alias("mark"), fingerprint(text_of(), shingle).alias("fp")), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first"))
    nodes = store(nodes, "nodes")
    found = components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    first = (nodes.join(found, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
             .agg(F.min("first").alias("first")).select("first.id", "first.mark"))
    stays = docs.withColumn("_simhash_mark", mark)
    same = stays["doc_id"].eqNullSafe(first["id"]) & (stays["_simhash_mark"] == first["mark"])
    return stays.join(first, same, "left_semi").dropDuplicates(["doc_id", "_simhash_mark"]).drop("_simhash_mark")
