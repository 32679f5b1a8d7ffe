"""Jaccard join of word n-gram sets by vertical partitioning.

All n-grams stand in one global order, rare ones first: by the class of a
count sketch (log2 of a counter), then by hash. The order is cut into
``FRAGMENTS`` fragments of about equal mass, so every set falls into segments.

* **Candidates.** Sets that link share an n-gram among the first
  ``n - ceil(share * n) + 1`` of each (prefix filter), so only those travel,
  once. At the first n-gram that two sets share, what follows it in either
  bounds their overlap (``_prefixes``); an n-gram of a set goes on only if some
  other set with it can reach the share from there. A pair must pass the length
  filter, a parity bitmap and a histogram: where these differ, only one set has
  n-grams.
* **Counting.** The overlap of a pair is the sum of its partial overlaps by
  fragment. Equal segments (64-bit digests) give their size at once; a pair
  that is not settled by these and by the sizes of the others has its unequal
  segments intersected, fragment by fragment, each in its own row.
* **Large groups.** Equal sets are one node from the start. First every prefix
  n-gram links its neighbours in two orders only (a number of pairs linear in
  the rows), which joins families of copies into components. Then only sets of
  *different* components that share a prefix n-gram are compared, in tiles, and
  all of them: a pair within one component can change nothing. So no pairs
  within a family are made, and no link between components is missed.

The order only moves work: any order gives the same links. The sketch is of
bounded size (``SKETCH``); the cell of a rare n-gram looks as full as the
average. N-grams are mixed XXH64 hashes of their words (64 bits), sets are
known by two digests (prefix n-grams by one of them and the size).

Defined cases: null text and text without words have an empty set that links
with nothing, so the component is the document's own id; a null ``doc_id``
takes part, and a component id is the smallest non-null id; repeated rows are
repeated in the result; an empty table gives an empty result; extra columns
are not read; a text of fewer words than ``size`` is one n-gram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store, text_of
from .components import components
from .count_min import Counters, cells, counters, merged, width_for

SIZE = 3
SHARE = (9, 10)
FRAGMENTS = 32
LANES = 8                 # 64-bit lanes of a set's parity bitmap, and of its histogram
SKETCH = 1 << 22          # counters at most; one byte each at the driver and in the broadcast
TILE = 2048


# ------------------------------------------------------------ sets

class _Words(dict):
    """XXH64 of words, remembered; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes (int64) of the word n-grams of a UTF-8 text."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.int64)
    one = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n])
    return np.unique(out.view(np.int64))


def _digest(data: bytes, seed: int) -> int:
    return int.from_bytes(xxhash.xxh64_digest(data, seed), "big", signed=True)


def parity(tokens: np.ndarray) -> np.ndarray:
    """``LANES * 64`` bits; a bit is set if an odd number of n-grams fall on it."""
    at = (tokens.view(np.uint64) >> np.uint64(20)).astype(np.int64) % (LANES * 64)
    odd = np.bincount(at, minlength=LANES * 64).astype(np.uint8) & 1
    return np.packbits(odd).view(">u8").astype(np.uint64).view(np.int64)


def histogram(tokens: np.ndarray) -> np.ndarray:
    """``LANES * 8`` counts modulo 256 of where n-grams fall."""
    at = (tokens.view(np.uint64) >> np.uint64(40)).astype(np.int64) % (LANES * 8)
    return np.bincount(at, minlength=LANES * 8).astype(np.uint8).view(np.int64)


LANE_NAMES = [f"b{i}" for i in range(LANES)]
BUCKET_NAMES = [f"h{i}" for i in range(LANES)]


def _slices(batches, rows: int = 256):
    """Few texts at a time, whatever the size of an Arrow batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sets(size, width):
    """Sets by their digests and bounds; at the end the task's part of the sketch."""
    names = ["id", "mark", "n", "d1", "d2", *LANE_NAMES, *BUCKET_NAMES, "block", "data"]

    def of(batches):
        sketch, types = Counters(width), None
        for batch in _slices(batches):
            found = [shingles(t or b"", size) for t in batch.column(2).to_pylist()]
            raw = [t.tobytes() for t in found]
            bits = np.array([parity(t) for t in found], np.int64).reshape(-1, LANES)
            fall = np.array([histogram(t) for t in found], np.int64).reshape(-1, LANES)
            if found:
                sketch.add(np.concatenate(found))
            types = batch.column(0).type
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(t) for t in found], pa.int64()),
                                              *(pa.array([_digest(r, s) for r in raw], pa.int64()) for s in (1, 2)), *(pa.array(bits[:, i]) for i in range(LANES)),
                                              *(pa.array(fall[:, i]) for i in range(LANES)), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.binary())], names)
        for at, data in sketch.blocks():
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, types), *[none] * (4 + 2 * LANES), pa.array([at], pa.int64()), pa.array([data], pa.binary())], names)
    return of


def _class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts, 1)).astype(np.uint8)


class Order:
    """The global order: class of the sketch, then hash; and its fragments."""

    def __init__(self, classes: np.ndarray):
        self.classes, self.width = classes, len(classes)
        mass = np.bincount(classes, minlength=64) * 2.0 ** np.arange(64)
        self.start = np.concatenate([[0.0], np.cumsum(mass)[:-1]]) / mass.sum()
        self.mass = mass / mass.sum()

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return self.classes[cells(tokens, self.width, 0)]

    def prefix(self, tokens: np.ndarray, share=SHARE) -> np.ndarray:
        """The first of sorted ``tokens`` in the order."""
        n = len(tokens)
        take = n - -(-n * share[0] // share[1]) + 1
        return tokens[np.argsort(self.of(tokens), kind="stable")[:take]]

    def fragments(self, tokens: np.ndarray) -> np.ndarray:
        kind = self.of(tokens)
        within = tokens.astype(np.float64) / 2.0 ** 64 + 0.5
        return np.minimum(((self.start[kind] + self.mass[kind] * within) * FRAGMENTS).astype(np.int64), FRAGMENTS - 1)


def broadcast_order(made: DataFrame, width: int):
    """The order of the sketch that the tasks left beside their sets, broadcast (``SKETCH`` bytes at most)."""
    classes = merged(made.where("block is not null").select("block", "data"), width, 1, _class)
    return made.sparkSession.sparkContext.broadcast(Order(classes))


class _Once(set):
    """What was met before, as far as it is remembered; emptied when it has grown large."""

    def new(self, key) -> bool:
        if key in self:
            return False
        if len(self) > 1 << 17:
            self.clear()
        self.add(key)
        return True


def _prefixes(order, size, share):
    """Prefix n-grams ``token, n, d1, reach``. If a set's n-gram at place ``k``
    is the first that it shares with another, they have ``n - k`` in common at
    most, so the other has ``reach`` n-grams at most."""
    num, den = share

    def of(batches):
        met = _Once()
        for batch in _slices(batches):
            out = []
            for text in batch.column(0).to_pylist():
                tokens = shingles(text or b"", size)
                raw, n = tokens.tobytes(), len(tokens)
                if not n or not met.new((_digest(raw, 1), _digest(raw, 2))):
                    continue
                first = order.value.prefix(tokens, share)
                reach = (den + num) * (n - np.arange(len(first))) // num - n
                out.append((first, np.full(len(first), n), np.full(len(first), _digest(raw, 1)), reach))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["token", "n", "d1", "reach"])
    return of


def _partnered(token: np.ndarray, n: np.ndarray, d1: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Rows, in order of (token, n, d1), with another set of the token such that
    each is within the other's reach; one of equal rows."""
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (d1[1:] != d1[:-1])
    rows = np.flatnonzero(new)
    token, n, reach = token[rows], n[rows], reach[rows]
    group = np.cumsum(np.diff(token, prepend=token[:1]) != 0) << 32
    size, far = group + n, group + reach
    # the two farthest among the rows so far; those of a group before are below every size of this one
    best = np.maximum.accumulate(far)
    second = np.maximum.accumulate(np.concatenate([[-1], np.minimum(far[1:], best[:-1])]))
    last = np.searchsorted(size, far, "right") - 1            # the last row within reach
    own = (np.arange(len(rows)) <= last) & (far == best[last])
    return rows[(last >= 0) & (np.where(own, second[last], best[last]) >= size)]


def _partners(batches):
    """Rows ``token, n, d1, reach`` in that order -> ``token, n, d1`` of those with a partner."""

    def out(parts):
        at = [np.concatenate(x) for x in zip(*parts, strict=True)]
        rows = _partnered(*at)
        return pa.RecordBatch.from_arrays([pa.array(x[rows]) for x in at[:3]], ["token", "n", "d1"])

    held = []                # the rows of the last token, and whole tokens before it
    for batch in batches:
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1], "left"))
        if held and (cut or held[-1][0][-1] != now[0][0]):
            yield out([*held, [x[:cut] for x in now]])
            held = []
        elif cut:
            yield out([[x[:cut] for x in now]])
        held.append([x[cut:] for x in now])
    if held:
        yield out(held)


def shared_prefixes(texts: DataFrame, nodes: DataFrame, order, size: int = SIZE, share=SHARE) -> DataFrame:
    """``token, nid, n`` of the prefix n-grams at which some pair of sets can link; they are shuffled once."""
    rows = texts.select("raw").mapInArrow(_prefixes(order, size, share), "token long, n long, d1 long, reach long")
    rows = rows.repartition("token").sortWithinPartitions("token", "n", "d1").mapInArrow(_partners, "token long, n long, d1 long")
    return rows.join(nodes.select("d1", "n", "nid"), ["d1", "n"]).select("token", "nid", "n")


# ------------------------------------------------------------ counting by fragment

def _segments(order, size):
    """Segments of whole sets: ``d1, d2, f, tokens, digest``."""
    names, types = ["d1", "d2", "f", "tokens", "digest"], [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64()]

    def of(batches):
        met = _Once()
        for batch in _slices(batches):
            for text in batch.column(0).to_pylist():
                tokens = shingles(text or b"", size)
                raw = tokens.tobytes()
                if not len(tokens) or not met.new((_digest(raw, 1), _digest(raw, 2))):
                    continue
                at = order.value.fragments(tokens)
                by = np.argsort(at, kind="stable")
                at, tokens = at[by], tokens[by]
                first = np.flatnonzero(np.diff(at, prepend=-1))
                parts = np.split(tokens, first[1:])
                d1, d2 = _digest(raw, 1), _digest(raw, 2)
                yield pa.RecordBatch.from_arrays([pa.array([d1] * len(parts), types[0]), pa.array([d2] * len(parts), types[1]), pa.array(at[first], types[2]),
                                                  pa.array(parts, types[3]), pa.array([_digest(p.tobytes(), 3) for p in parts], types[4])], names)
    return of


def _bits(counts: np.ndarray) -> np.ndarray:
    return np.packbits(counts > 0)


def _member(keys: DataFrame, n: int):
    """A column function: may the key be among ``keys``? (No key is missed.)"""
    width = width_for(n, 1 / 16, most=1 << 24)
    bits = keys.sparkSession.sparkContext.broadcast(counters(keys, width, 2, _bits))     # 4 MB at most

    @F.arrow_udf("boolean")
    def inside(found: pa.Array) -> pa.Array:
        keys, out = found.to_numpy(zero_copy_only=False), np.ones(len(found), bool)
        for row in range(2):
            at = cells(keys, width, row) + row * width
            out &= (bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return pa.array(out)

    return inside


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, order, size: int = SIZE, share=SHARE) -> DataFrame:
    """The pairs ``(a, b)`` of node numbers whose sets link, by partial overlaps."""
    num, den = share
    ends = pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct()
    wanted = store(nodes.join(ends, "nid", "left_semi").select("nid", "n", "d1", "d2", "key"), "wanted")
    inside = _member(wanted.select("key"), wanted.count())
    # one row per document and fragment, stored where it was made; a set that two documents have may come twice
    parts = store(texts.where(inside("key")).select("raw").mapInArrow(_segments(order, size), "d1 long, d2 long, f int, tokens array<long>, digest long"), "segments")
    ids = wanted.select("nid", "d1", "d2")
    slim = parts.select("d1", "d2", "f", F.size("tokens").alias("size"), "digest").distinct().join(ids, ["d1", "d2"])
    slim = slim.groupBy("nid").agg(F.map_from_entries(F.collect_list(F.struct("f", F.struct("size", "digest")))).alias("m"))     # FRAGMENTS entries at most
    slim = slim.join(wanted.select("nid", "n"), "nid")
    both = pairs.join(slim.select(F.col("nid").alias("a"), F.col("m").alias("ma"), F.col("n").alias("na")), "a")
    both = both.join(slim.select(F.col("nid").alias("b"), F.col("m").alias("mb"), F.col("n").alias("nb")), "b")
    least = lambda f: F.when(F.col("ma")[f]["digest"] == F.col("mb")[f]["digest"], F.col("ma")[f]["size"]).otherwise(0)
    most = lambda f: F.coalesce(F.least(F.col("ma")[f]["size"], F.col("mb")[f]["size"]), F.lit(0))
    shared = F.map_keys("ma")
    total = lambda of: F.aggregate(F.transform(shared, of), F.lit(0).cast("long"), lambda x, y: x + F.coalesce(y, F.lit(0)))
    # overlap needed: den * I >= num * (na + nb - I)
    both = both.select("a", "b", "na", "nb", total(least).alias("sure"), total(lambda f: F.when(F.col("mb")[f].isNotNull(), most(f)).otherwise(0)).alias("top"),
                       F.filter(shared, lambda f: F.col("mb")[f].isNotNull() & (F.col("ma")[f]["digest"] != F.col("mb")[f]["digest"])).alias("open"))
    need = lambda c: (den + num) * F.col(c) >= num * (F.col("na") + F.col("nb"))
    both = store(both.where(need("top")), "bounds")
    rest = both.where(~need("sure")).select("a", "b", F.explode("open").alias("f"))
    rest = store(rest, "open")
    # only the segments in question travel: once by their own key, which both ends of a pair meet, and once from a to b
    ends = rest.select(F.col("a").alias("nid"), "f").union(rest.select("b", "f")).distinct().join(ids, "nid").select("d1", "d2", "f")
    ends = store(ends, "asked")
    open_part = F.xxhash64("d1", "d2", "f")
    some = _member(ends.select(open_part), ends.count())
    open_parts = parts.where(some(open_part)).select("d1", "d2", "f", "tokens").dropDuplicates(["d1", "d2", "f"])
    end = lambda c: ids.select(F.col("nid").alias(c), F.col("d1").alias(f"{c}1"), F.col("d2").alias(f"{c}2"))
    at = lambda c: open_parts.select(F.col("d1").alias(f"{c}1"), F.col("d2").alias(f"{c}2"), "f", F.col("tokens").alias(f"t{c}"))
    rest = rest.join(end("a"), "a").join(end("b"), "b").join(at("a"), ["a1", "a2", "f"]).select("a", "b", "b1", "b2", "f", "ta").join(at("b"), ["b1", "b2", "f"])
    partial = rest.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("ta", "tb"))).alias("more"))
    counted = both.where(~need("sure")).join(partial, ["a", "b"], "left").withColumn("all", F.col("sure") + F.coalesce("more", F.lit(0)))
    return both.where(need("sure")).select("a", "b").union(counted.where(need("all")).select("a", "b"))


# ------------------------------------------------------------ candidates

def _neighbours(share):
    """Rows (token, nid, n) in an order -> neighbours within a token that pass the length filter."""
    num, den = share

    def of(batches):
        last = None
        for batch in batches:
            t, i, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if last is not None:
                t, i, n = (np.concatenate([[x], y]) for x, y in zip(last, (t, i, n), strict=True))
            if not len(t):
                continue
            last = (t[-1], i[-1], n[-1])
            small, large = np.minimum(n[1:], n[:-1]), np.maximum(n[1:], n[:-1])
            ok = (t[1:] == t[:-1]) & (den * small >= num * large)
            a, b = i[1:][ok], i[:-1][ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return of


def chains(shared: DataFrame, share=SHARE) -> DataFrame:
    """Each shared n-gram links neighbours by size and neighbours by hash."""
    n = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shared.select("token", "nid", "n")
    made = None
    for by in (["n", "nid"], [F.xxhash64("nid")]):
        part = rows.repartitionByRange(n, "token", *by).sortWithinPartitions("token", *by).mapInArrow(_neighbours(share), "a long, b long")
        made = part if made is None else made.union(part)
    return made.distinct()


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least so many n-grams are in one set only, by parity (columns are lanes)."""
    return sum(np.bitwise_count(a[:, k] ^ b[:, k]).astype(np.int64) for k in range(LANES))


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same by histograms (bytes, modulo 256)."""
    d = a.view(np.uint8) - b.view(np.uint8)
    return np.minimum(d, -d).astype(np.int64).sum(axis=1)


def _possible(share):
    num, den = share

    def of(batches):
        for batch in batches:
            at = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
            block = lambda k: np.ascontiguousarray(np.stack(at[k:k + LANES], axis=1)).view(np.uint64)
            if len(at[0]):
                room = (den - num) * (at[2] + at[3])
                ok = ((den + num) * _apart(block(4), block(4 + 2 * LANES)) <= room) & ((den + num) * _spread(block(4 + LANES), block(4 + 3 * LANES)) <= room)
                yield pa.RecordBatch.from_arrays([pa.array(at[0][ok]), pa.array(at[1][ok])], ["a", "b"])
    return of


def bounded(pairs: DataFrame, nodes: DataFrame, share=SHARE) -> DataFrame:
    """Pairs that neither parity bitmaps nor histograms rule out."""
    every = [*LANE_NAMES, *BUCKET_NAMES]
    side = lambda c: nodes.select(F.col("nid").alias(c), F.col("n").alias(f"n{c}"), *(F.col(x).alias(f"{c}{x}") for x in every))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "na", "nb", *(f"a{x}" for x in every), *(f"b{x}" for x in every)).mapInArrow(_possible(share), "a long, b long")


def _tiles(share, small: int = 32, side: int = 256):
    """Rows (task, nid, n, root, bitmap) in order of task -> pairs of different
    components that pass the length and bitmap filters."""
    num, den = share

    def fits(n, root, bits, a, b):
        ok = (root[a] != root[b]) & (den * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b]))
        a, b = a[ok], b[ok]
        ok = (den + num) * _apart(bits[a], bits[b]) <= (den - num) * (n[a] + n[b])
        return a[ok], b[ok]

    def large(n, root, bits):
        order = np.argsort(n, kind="stable")
        n, root, bits = n[order], root[order], bits[order]
        for i in range(0, len(n), side):
            for j in range(i, len(n), side):
                if den * n[i:i + side][-1] < num * n[j]:
                    break                   # sizes only rise from here on
                apart = root[i:i + side, None] != root[None, j:j + side]
                if apart.any():
                    a, b = np.nonzero(apart)
                    a, b = fits(n, root, bits, a + i, b + j)
                    yield order[a], order[b]

    def pairs(task, nid, n, root, bits):
        edge = np.flatnonzero(np.diff(task, prepend=task[0] - 1))
        many = np.diff(edge, append=len(task))
        found = []
        few = np.repeat(many <= small, many)
        for d in range(1, int(many[many <= small].max(initial=1))):     # small groups, all at once
            a = np.flatnonzero((task[d:] == task[:-d]) & few[d:])
            found.append(fits(n, root, bits, a, a + d))
        for e, m in zip(edge[many > small], many[many > small], strict=True):
            found += [(a + e, b + e) for a, b in large(n[e:e + m], root[e:e + m], bits[e:e + m])]
        a = nid[np.concatenate([p[0] for p in found])] if found else np.empty(0, np.int64)
        b = nid[np.concatenate([p[1] for p in found])] if found else np.empty(0, np.int64)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def of(batches):
        held = None
        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            now.append(np.stack([batch.column(4 + k).to_numpy(zero_copy_only=False) for k in range(LANES)], axis=1).view(np.uint64) if len(now[0]) else np.empty((0, LANES), np.uint64))
            held = now if held is None else [np.concatenate(p) for p in zip(held, now, strict=True)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1], "left"))
            if last:
                yield pairs(*(p[:last] for p in held))
                held = [p[last:] for p in held]
        if held is not None and len(held[0]):
            yield pairs(*held)
    return of


def across(shared: DataFrame, nodes: DataFrame, found: DataFrame, share=SHARE, tile: int = TILE) -> DataFrame:
    """All candidate pairs of different components. ``found(nid, root)`` holds
    the components so far; a set without one is its own."""
    rows = shared.select("token", "nid").join(found, "nid", "left").select("token", "nid", F.coalesce("root", "nid").alias("root"))
    rows = store(rows, "rooted")
    mixed = rows.groupBy("token").agg(F.count("*").alias("m"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token", "m")
    rows = rows.join(mixed, "token")
    cool = rows.where(F.col("m") <= tile).select(F.xxhash64("token").alias("task"), "nid", "root")
    # larger groups: a component of more than a tile is a unit of its own, the others are one unit; units are dealt in slots
    hot = rows.where(F.col("m") > tile)
    size = hot.groupBy("token", "root").agg(F.count("*").alias("c")).withColumn("big", F.col("c") > tile)
    unit = F.when(F.col("big"), F.col("root"))
    units = size.groupBy("token", unit.alias("unit")).agg(F.ceil(F.sum("c") / F.lit(tile)).cast("long").alias("slots"))
    placed = hot.join(size, ["token", "root"]).withColumn("unit", unit).join(units.withColumnRenamed("unit", "u").withColumnRenamed("token", "t"), F.expr("token = t and unit <=> u"))
    placed = placed.select("token", "unit", F.pmod(F.xxhash64("nid"), F.col("slots")).alias("slot"), "nid", "root")
    slot = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    other = units.select("token", F.col("unit").alias("unit2"), F.col("slots").alias("slots2"))
    pairs = units.join(other, "token").where("unit is null or unit < unit2")       # one big component is never met with itself
    pairs = pairs.select("token", "unit", "unit2", "slots2", slot("slots").alias("slot")).select("token", "unit", "unit2", "slot", slot("slots2").alias("slot2"))
    pairs = pairs.where("unit is not null or unit2 is not null or slot <= slot2")
    pairs = pairs.withColumn("task", F.xxhash64("token", "unit", "slot", F.lit(0), "unit2", "slot2"))
    ends = pairs.select("token", "unit", "slot", "task").union(pairs.select("token", F.col("unit2"), F.col("slot2"), "task")).distinct()
    ends = ends.select(F.col("token").alias("t"), F.col("unit").alias("u"), F.col("slot").alias("s"), "task")
    dealt = placed.join(ends, F.expr("token = t and unit <=> u and slot = s")).select("task", "nid", "root")
    tasks = cool.union(dealt).join(nodes.select("nid", "n", *LANE_NAMES), "nid").select("task", "nid", "n", "root", *LANE_NAMES)
    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_tiles(share), "a long, b long").distinct()


# ------------------------------------------------------------ the join

def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, share=SHARE, tile: int = TILE, sketch: int = SKETCH) -> DataFrame:
    """One row per document: ``id, n, component_id``."""
    raw = text_of(text_col).cast("binary")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("mark"), raw.alias("raw")).withColumn("key", F.xxhash64("id", "mark"))
    id_type = texts.schema["id"].dataType.simpleString()
    numbers = ", ".join(f"{x} long" for x in (*LANE_NAMES, *BUCKET_NAMES))
    width = width_for((texts.agg(F.sum(F.octet_length("raw")).alias("n")).first()["n"] or 0) // 6, 1.0, most=sketch)
    made = texts.select("id", "mark", "raw").mapInArrow(_sets(size, width), f"id {id_type}, mark long, n long, d1 long, d2 long, {numbers}, block long, data binary")
    made = store(made, "sets")
    order = broadcast_order(made, width)
    sets = made.where("block is null").drop("block", "data")
    full = sets.where("n > 0")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first")
    every = [*LANE_NAMES, *BUCKET_NAMES]
    nodes = full.groupBy("d1", "d2").agg(first, F.min("id").alias("least"), F.max("n").alias("n"), *(F.max(x).alias(x) for x in every))
    nodes = store(nodes.select("d1", "d2", "n", "least", F.xxhash64("first.id", "first.mark").alias("key"), *every, F.monotonically_increasing_id().alias("nid")), "nodes")
    shared = store(shared_prefixes(texts, nodes, order, size, share), "shared")
    # families first, by a linear number of pairs; then all pairs of different components
    tried = store(bounded(chains(shared, share), nodes, share), "tried")
    links = store(verified(tried, nodes, texts, order, size, share), "links")
    found = components(links).select(F.col("node").alias("nid"), "root")
    rest = store(bounded(across(shared, nodes, found, share, tile), nodes, share).join(tried, ["a", "b"], "left_anti"), "rest")
    links = links.union(verified(rest, nodes, texts, order, size, share))
    found = components(links).select(F.col("node").alias("nid"), "root")
    nodes = store(nodes.select("d1", "d2", "least", "nid").join(found, "nid", "left").withColumn("root", F.coalesce("root", "nid")), "rooted")
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = nodes.join(least, "root").select("d1", "d2", "component_id")
    rows = full.select("id", "n", "d1", "d2").join(classes, ["d1", "d2"]).select("id", "n", "component_id")
    return rows.union(sets.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
