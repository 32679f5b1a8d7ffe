"""Exact substring dedup with common-prefix interval trees.

Goal: every byte covered by a ``LEAST``-byte string that also starts anywhere
else is removed. A suffix array of all bytes of a corpus can't be held, and
need not be: only suffixes that start at an *anchor* are sorted.

1. The anchor of a window of ``LEAST`` bytes is its ``GRAM``-byte gram of the
   least hash. It follows from the window's bytes alone, so equal windows have
   equal anchors at the same place. Neighbouring windows mostly share their
   anchor; together they are one *stretch* (at most 360 bytes).
2. Stretches meet by the hash of their anchor (one shuffle of 40 bytes a
   stretch, about one per 80 bytes of text). Copies inside an Arrow batch are
   settled before it, so a group of copies of any size arrives as a few rows.
   A stretch found twice is a repeat as a whole.
3. Where an anchor has several different stretches, their bytes are fetched
   and an enhanced suffix array of the suffixes at the anchor is built per
   group: sorted right contexts, longest common prefixes, and a stack scan
   that gives the tree of common-prefix intervals. In each interval the left
   contexts are sorted too; the longest left extension shared with another
   member tells whether the interval is left-diverse and how far each member's
   repeat reaches, so each interval gives a maximal repeat with all occurrences.
4. Groups of more than ``GROUP`` different stretches (the edge of a passage in
   very many texts) are split into their single windows, which Spark counts
   with partial aggregates. No group is ever held by one task beyond ``GROUP``.

The texts are shuffled (as zstd) for the two joins by document; what the
stretches tell is written to the shared folder between the steps. Exact: hashes only propose (128 bits for whole stretches and single
windows), interval bounds are byte comparisons.

Defined cases: null text is empty; texts under ``LEAST`` bytes lose nothing;
a null or repeated ``doc_id`` is allowed (rows are then told apart by their
text, and equal rows count as each other's copies); an empty table gives an
empty result; extra columns are not read; texts of any length are whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, store, unpack

LEAST, GRAM, GROUP = 200, 40, 4096
CHUNK = 1 << 19
_RANDOM = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a string from the hashes of its two halves."""
    z = a * _A + b
    z ^= z >> np.uint64(31)
    z *= _B
    return z


def _grams(buf: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the strings of 8, 32, 40 and 128 bytes at every position."""
    out, size, h = {}, 1, _RANDOM[buf]
    while size < 128 and len(h) > size:
        h = _join(h[:-size], h[size:])
        size *= 2
        out[size] = h
    return out


def _least_in_windows(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of keys[s : s + w] for each s, by block prefixes and suffixes."""
    n = len(keys) - w + 1
    blocks = -(-len(keys) // w)
    grid = np.full(blocks * w, np.uint64(2**64 - 1))
    grid[:len(keys)] = keys
    grid = grid.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def stretches(buf: np.ndarray, first: np.ndarray, last: np.ndarray):
    """``buf`` holds texts one after the other; their windows start at
    first[i] .. last[i]. Gives arrays: text index, start, anchor - start,
    end - start of the window starts, hash of the anchor, hash of the stretch."""
    w = LEAST - GRAM + 1
    g = _grams(buf)
    gram = _join(g[32][:len(buf) - GRAM + 1], g[8][32:32 + len(buf) - GRAM + 1])
    place = np.uint64((1 << 20) - 1)
    keys = ((gram ^ (gram >> np.uint64(29))) & ~place) | np.arange(len(gram), dtype=np.uint64)
    anchor = (_least_in_windows(keys, w) & place).astype(np.int64)
    inside = np.zeros(len(buf) + 1, np.int8)
    np.add.at(inside, first, 1)
    np.add.at(inside, last + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    owner = np.searchsorted(first, at, "right") - 1
    cut = np.flatnonzero((anchor[at[1:]] != anchor[at[:-1]]) | (owner[1:] != owner[:-1]))
    start, end = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]
    anchor = anchor[start]
    size = end - start + LEAST
    h = g[128]
    whole = _join(_join(h[start], h[start + size - 128]), h[start + (size - 128) // 2] + size.astype(np.uint64))
    return owner[np.concatenate([[0], cut + 1])], start, anchor - start, end - start, gram[anchor], whole


def _slabs(texts: list[bytes]):
    """Texts in lots of about CHUNK bytes: lists of (row, offset in the text,
    bytes, windows); a longer text is cut into slabs that overlap by a window."""
    lot, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LEAST + 1), CHUNK):
            windows = min(CHUNK, len(text) - LEAST + 1 - at)
            if windows < 1:
                continue
            part = text[at:at + windows + LEAST - 1]
            if lot and size + len(part) > CHUNK:
                yield lot
                lot, size = [], 0
            lot.append((row, at, part, windows))
            size += len(part)
    if lot:
        yield lot


PLACED = "ah long, sh long, ident long, s long, meta int"


def _place(batches):
    """(ident, raw) -> one row per stretch. ``meta`` is anchor << 8 | windows - 1,
    plus 1 << 16 if the batch holds copies of it; copies themselves come as
    finished spans: meta is minus their length, and ``ah`` is spread."""
    for batch in batches:
        idents = batch.column(0).to_numpy(zero_copy_only=False)
        found = []
        for lot in _slabs([t or b"" for t in batch.column(1).to_pylist()]):
            begin = np.concatenate([[0], np.cumsum([len(x[2]) for x in lot])])
            first = begin[:-1]
            last = first + np.array([x[3] for x in lot]) - 1
            who, start, anchor, more, ah, sh = stretches(np.frombuffer(b"".join(x[2] for x in lot), np.uint8), first, last)
            rows, offset = np.array([x[0] for x in lot]), np.array([x[1] for x in lot])
            found.append((rows[who], start - first[who] + offset[who], anchor, more, ah.view(np.int64), sh.view(np.int64)))
        if not found:
            continue
        row, s, anchor, more, ah, sh = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((sh, ah))
        same = (ah[order][1:] == ah[order][:-1]) & (sh[order][1:] == sh[order][:-1])
        copy, twice = np.zeros(len(ah), bool), np.zeros(len(ah), bool)
        copy[order[1:]] = same
        twice[order[:-1]] = same
        stay = ~copy
        yield _table(ah[stay], sh[stay], idents[row[stay]], s[stay], (anchor << 8 | more | twice.astype(np.int64) << 16)[stay])
        row, s, e = row[copy], s[copy], (s + more + LEAST)[copy]
        if len(row):                    # join the spans of neighbouring copies
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (s[1:] > e[:-1])])
            at = np.flatnonzero(new)
            s, e, ident = s[at], e[np.concatenate([at[1:] - 1, [len(e) - 1]])], idents[row[at]]
            spread = _join(ident.astype(np.int64).view(np.uint64), s.astype(np.uint64)).view(np.int64)
            yield _table(spread, np.zeros(len(s), np.int64), ident, s, -(e - s))


def _table(ah, sh, ident, s, meta):
    return pa.RecordBatch.from_arrays([pa.array(ah), pa.array(sh), pa.array(ident.astype(np.int64)), pa.array(s.astype(np.int64)), pa.array(meta.astype(np.int32))], ["ah", "sh", "ident", "s", "meta"])


#: Kinds of row after the meeting: a finished span, a member of a group whose
#: reach is open, a finished member that stands for its copies; the same two
#: in groups of more than GROUP.
SPAN, OPEN, KNOWN, HOT_OPEN, HOT_KNOWN = range(5)
MET = "ident long, ah long, s long, meta int, kind int"


def _meet(group: int):
    def meet(batches):
        """Rows in order of (ah, sh); holds at most one group, up to ``group``
        different stretches and the rows of one batch."""
        held, hot = None, None

        def settle(ah, sh, ident, s, meta, big):
            """Whole groups (or parts of big ones) in order."""
            new = np.concatenate([[True], (ah[1:] != ah[:-1]) | (sh[1:] != sh[:-1])])
            at = np.flatnonzero(new)
            count = np.diff(at, append=len(ah))
            multiple = (count > 1) | (np.maximum.reduceat(meta, at) >= 1 << 16)
            meta = meta & 0xFFFF
            done = np.repeat(multiple, count)
            heads = ah[at]
            fresh = np.concatenate([[True], heads[1:] != heads[:-1]])
            number = np.cumsum(fresh) - 1
            kinds = np.bincount(number)
            many = kinds[number] > 1
            big = big | (kinds[number] > group)
            many |= big
            out = [(ident[done], ah[done], s[done], (meta[done] & 255) + LEAST, np.full(done.sum(), SPAN))]
            lead = at[many]
            kind = np.where(multiple[many], KNOWN, OPEN) + np.where(big[many], HOT_OPEN - OPEN, 0)
            out.append((ident[lead], ah[lead], s[lead], meta[lead], kind))
            a, b, c, d, e = (np.concatenate(x) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c), pa.array(d.astype(np.int32)), pa.array(e.astype(np.int32))], ["ident", "ah", "s", "meta", "kind"])

        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            ready = cols[4] < 0
            if ready.any():
                ident, s, size = cols[2][ready], cols[3][ready], -cols[4][ready]
                yield pa.RecordBatch.from_arrays([pa.array(ident), pa.array(cols[0][ready]), pa.array(s), pa.array(size), pa.array(np.full(len(s), SPAN, np.int32))], ["ident", "ah", "s", "meta", "kind"])
                cols = [c[~ready] for c in cols]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            # the last run of equal (ah, sh) may go on: it always waits
            tail = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            run = tail + int(np.searchsorted(cols[1][tail:], cols[1][-1], "left"))
            if hot is not None:
                upto = int(np.searchsorted(cols[0], hot, "right"))
                upto = min(upto, run)
                if upto:
                    yield settle(*(c[:upto] for c in cols), np.True_)
                cols = [c[upto:] for c in cols]
                tail, run = max(0, tail - upto), run - upto
                if cols[0][0] != hot:
                    hot = None
            if hot is None and tail:
                yield settle(*(c[:tail] for c in cols), np.False_)
                cols, run, tail = [c[tail:] for c in cols], run - tail, 0
            if hot is None and run > group:
                hot = cols[0][-1]
                yield settle(*(c[:run] for c in cols), np.True_)
                cols = [c[run:] for c in cols]
            held = cols
            if len(held[0]) > 1:        # copies beyond two say nothing more, but each is a span
                end = np.flatnonzero((held[0] == held[0][-1]) & (held[1] == held[1][-1]))
                if len(end) > 2 * group:
                    keep = end[:2]
                    rest = end[2:]
                    yield pa.RecordBatch.from_arrays([pa.array(held[2][rest]), pa.array(held[0][rest]), pa.array(held[3][rest]), pa.array(((held[4][rest] & 255) + LEAST).astype(np.int32)), pa.array(np.full(len(rest), SPAN, np.int32))], ["ident", "ah", "s", "meta", "kind"])
                    stay = np.concatenate([np.arange(end[0]), keep])
                    held = [c[stay] for c in held]
        if held is not None and len(held[0]):
            big = held[0] == (hot if hot is not None else 0)
            if hot is not None and big.any():
                yield settle(*(c[big] for c in held), np.True_)
                held = [c[~big] for c in held]
            if len(held[0]):
                yield settle(*held, np.False_)

    return meet


def _fetch(batches):
    """(ident, packed, marks) -> the bytes of the open and known stretches."""
    for batch in batches:
        out = []
        for ident, data, marks in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            raw = unpack(data)
            for m in marks:
                if m["kind"] != SPAN:
                    s, anchor, more = m["s"], m["meta"] >> 8, m["meta"] & 255
                    out.append((m["ah"], ident, s, anchor, raw[s:s + more + LEAST], m["kind"]))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["ah", "ident", "s", "anchor", "raw", "kind"])


FETCHED = "ah long, ident long, s long, anchor int, raw binary, kind int"


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def prefix_intervals(lcp: list[int]):
    """Stack scan: (length, first, last) of each common-prefix interval of a
    suffix array whose neighbours share lcp[i] bytes with the next."""
    stack: list[tuple[int, int]] = []
    for i, here in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, i
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def maximal_repeats(members: list[tuple[bytes, int]], least: int = LEAST):
    """``members``: (bytes, place of the anchor). Yields the maximal repeats
    across the anchor of at least ``least`` bytes: lists of (member, start, end)."""
    right = [raw[at:] for raw, at in members]
    left = [raw[:at][::-1] for raw, at in members]
    array = sorted(range(len(members)), key=right.__getitem__)
    lcp = [common_prefix(right[a], right[b]) for a, b in zip(array, array[1:], strict=False)]
    for length, first, last in prefix_intervals(lcp):
        need = max(0, least - length)
        group = [m for m in array[first:last + 1] if len(left[m]) >= need]
        if length == 0 or len(group) < 2:
            continue
        group.sort(key=left.__getitem__)
        shared = [common_prefix(left[a], left[b]) for a, b in zip(group, group[1:], strict=False)]
        # the longest left extension shared with any member is shared with a neighbour
        reach = [max(a, b) for a, b in zip([-1, *shared], [*shared, -1], strict=True)]
        found = [(m, members[m][1] - r, members[m][1] + length) for m, r in zip(group, reach, strict=True) if r >= need]
        if found:
            yield found


def _grow(batches):
    """Stretches in order of ah -> spans of those whose reach was open."""
    held: list[dict] = []

    def spans(rows):
        for found in maximal_repeats([(r["raw"], r["anchor"]) for r in rows]):
            for m, a, b in found:
                if rows[m]["kind"] == OPEN:
                    yield rows[m]["ident"], rows[m]["s"] + a, b - a

    def batch_of(out):
        cols = list(zip(*out, strict=True)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["ident", "s", "size"])

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and held[-1]["ah"] != row["ah"]:
                out.extend(spans(held))
                held = []
            held.append(row)
        yield batch_of(out)
    yield batch_of(list(spans(held)) if held else [])


def _windows(batches):
    """Every window of the stretches of groups too large to hold."""
    for batch in batches:
        for row in batch.to_pylist():
            raw = row["raw"]
            n = len(raw) - LEAST + 1
            marks = [hashlib.blake2b(raw[k:k + LEAST], digest_size=16).digest() for k in range(n)]
            h = np.frombuffer(b"".join(marks), np.int64).reshape(n, 2)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.full(n, row["ident"])), pa.array(np.arange(n) + row["s"]), pa.array(np.full(n, row["kind"], np.int32))], ["h1", "h2", "ident", "s", "kind"])


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ident, raw): ident is the id where ids tell rows apart."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    seen = docs.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    ident = F.col("doc_id").cast("long") if seen["n"] == seen["ids"] else F.xxhash64("doc_id", "text")
    return docs.select("doc_id", ident.alias("ident"), raw.alias("raw"))


def _by_document(keyed: DataFrame) -> DataFrame:
    return keyed.select("doc_id", "ident", packed(F.col("raw")).alias("packed"))


def repeated_spans(keyed: DataFrame, group: int = GROUP) -> DataFrame:
    """``ident, marks, grown``: the finished spans of each document by way of
    stretches (marks of kind SPAN) and of interval trees and windows (grown)."""
    met = (keyed.select("ident", "raw").mapInArrow(_place, PLACED).repartition("ah").sortWithinPartitions("ah", "sh")
           .mapInArrow(_meet(group), MET))
    mark = F.struct("s", "meta", "kind", F.when(F.col("kind") != SPAN, F.col("ah")).alias("ah"))
    marks = store(met.groupBy("ident").agg(F.collect_list(mark).alias("marks"), F.max("kind").alias("most")), "marks")
    wanted = marks.where(F.col("most") > SPAN).select("ident", "marks")
    fetched = _by_document(keyed).join(wanted, "ident").select("ident", "packed", "marks").mapInArrow(_fetch, FETCHED)
    hot = bool(marks.where(F.col("most") > KNOWN).limit(1).count())
    if hot:         # otherwise there is no such group and nothing to split
        fetched = store(fetched, "fetched")
    cool = fetched.where(F.col("kind") <= KNOWN).repartition("ah").sortWithinPartitions("ah")
    grown = cool.mapInArrow(_grow, "ident long, s long, size long")
    if hot:
        windows = fetched.where(F.col("kind") > KNOWN).mapInArrow(_windows, "h1 long, h2 long, ident long, s long, kind int")
        weight = F.when(F.col("kind") == HOT_KNOWN, 2).otherwise(1)
        often = windows.groupBy("h1", "h2").agg(F.sum(weight).alias("n")).where("n > 1").drop("n")
        split = windows.where(F.col("kind") == HOT_OPEN).join(often, ["h1", "h2"]).select("ident", "s", F.lit(LEAST).cast("long").alias("size"))
        grown = grown.union(split)
    grown = store(grown.groupBy("ident").agg(F.collect_list(F.struct("s", "size")).alias("grown")), "grown")
    return marks.select("ident", "marks").join(grown, "ident", "left")


def _cut(batches):
    """The kept bytes of each document, as their digest."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out = []
        for doc, data, marks, grown in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            raw = unpack(data)
            spans = [(m["s"], m["s"] + m["meta"]) for m in marks or () if m["kind"] == SPAN] + [(g["s"], g["s"] + g["size"]) for g in grown or ()]
            kept, removed, runs, end = hashlib.sha256(), 0, 0, 0
            last = -1
            for a, b in sorted(spans):
                if a > last:
                    kept.update(raw[end:a])
                    runs += 1
                if b > last:
                    removed += b - max(a, last)
                    last = end = b
            kept.update(raw[end:])
            out.append((doc, len(raw), removed, runs, kept.hexdigest()))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()], strict=True)], names)


def without_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    keyed = _keyed(docs)
    found = repeated_spans(keyed, group)
    joined = _by_document(keyed).join(found, "ident", "left")
    return joined.select("doc_id", "packed", "marks", "grown").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
