"""Spelling variants of a vocabulary: k-d trees over letter-count vectors.

Two words are near if one inserted, deleted or replaced code point parts them.
Such an edit moves the letter counts by one up at most and one down at most
(L1 distance two), so near words of a word lie in a small box range of the
counts of words of the same length, one more and one less.

* A k-d tree of each length, with splits fitted on a bounded sample of the
  vocabulary (``SAMPLE`` words), cuts the words into cells. The splits only
  balance the work: every word is put into a cell, and a query goes to every
  cell whose box its range meets.
* A cell is one task group: a local k-d tree over its words, ranges pruned by
  boxes, leaves by the parity of letter counts, and letter order verified on
  what is left. Cells too large for one task are dealt out in slots; a query
  then goes to each slot.
* Near words are summed up in the task; only one row per word and cell leaves
  it (count, best), never the pairs.
* Forms lead to words at least ``FACTOR`` times as frequent, so chains are
  short; roots come by pointer doubling.

Letters are counted in ``DIMS`` buckets: letters that share one only make the
pruning weaker.

Defined cases: null text has no words; a null ``doc_id`` counts as the empty
text in the checksum; repeated rows count each; an empty vocabulary gives no
rows; extra columns are not read. Words of any length are compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT, FACTOR = 6, 5, 5
DIMS = 32
SAMPLE = 50_000           # words that the splits are fitted on
CELL = 16_384             # words in a cell, about
HELD = 1 << 20            # letters of a slot's words, at most about (CELL words at least)
LEAF = 96
EDITS = ((0, 1, 1), (1, 1, 0), (-1, 0, 1))    # length of the near word less that of the word; counts up, down


# ------------------------------------------------------------ vocabulary

def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, run``: maximal letter runs of at least ``LEAST_LETTERS``, A-Z lowered."""
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"({LETTERS}{{{LEAST_LETTERS},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rows.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, upper.lower())).otherwise(F.col("run")).alias("run"))


def slipped(rows: DataFrame, every: int = 199) -> DataFrame:
    """``word``: one run in ``every`` (by CRC-32 of ``id:run``) loses a letter."""
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    rows = rows.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of words long and frequent enough; counted behind partial sums."""
    return words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# ------------------------------------------------------------ vectors and trees

def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), -1)


def counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts in ``DIMS`` buckets, cut off at 100 (which keeps every bound)."""
    plain = codes - 97
    bucket = np.where(plain < 26, plain, 26 + codes % (DIMS - 26)).astype(np.int64)
    rows, size = codes.shape
    out = np.zeros((rows, DIMS), np.int8)
    step = max(1, (1 << 22) // max(1, size))
    for a in range(0, rows, step):
        part = bucket[a:a + step]
        flat = np.bincount((part + np.arange(len(part))[:, None] * DIMS).ravel(), minlength=len(part) * DIMS)
        out[a:a + step] = np.minimum(flat, 100).reshape(-1, DIMS)
    return out


def parities(codes: np.ndarray) -> np.ndarray:
    """One bit per code point modulo 64: set if it stands an odd number of times."""
    out = np.zeros(len(codes), np.uint64)
    for i in range(codes.shape[1]):
        out ^= np.uint64(1) << (codes[:, i] & 63).astype(np.uint64)
    return out


def best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """The (dimension, value) that halves the points best: left is below value."""
    n, best = len(points), None
    order = np.sort(points, axis=0)
    middle = order[n // 2]
    for cut in (middle, middle + 1):
        left = (points < cut).sum(axis=0)
        even = np.minimum(left, n - left)
        d = int(even.argmax())
        if even[d] and (best is None or even[d] > best[0]):
            best = (int(even[d]), d, int(cut[d]))
    return best and best[1:]


def split(points: np.ndarray, size: float):
    """A nested tuple ``(dimension, value, left, right)``; a leaf is None."""
    cut = best_cut(points) if len(points) > size else None
    if cut is None:
        return None
    below = points[:, cut[0]] < cut[1]
    return (*cut, split(points[below], size), split(points[~below], size))


def leaves(tree, at: int = 0):
    """Number the leaves: ``(tree with numbers for leaves, next number)``."""
    if tree is None:
        return at, at + 1
    left, at = leaves(tree[2], at)
    right, at = leaves(tree[3], at)
    return (tree[0], tree[1], left, right), at


def place(tree, points: np.ndarray) -> np.ndarray:
    """The leaf of every point."""
    out = np.zeros(len(points), np.int64)
    todo = [(tree, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, tuple):
            below = points[rows, node[0]] < node[1]
            todo += [(node[2], rows[below]), (node[3], rows[~below])]
        else:
            out[rows] = node
    return out


def visits(tree, points: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """``(point, leaf)`` for every leaf that may hold a vector reached with
    ``up`` counts more and ``down`` fewer."""
    found_p, found_l = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    none = np.zeros(len(points), np.int16)
    todo = [(tree, np.arange(len(points)), none, none, np.full(DIMS, -1, np.int16), np.full(DIMS, 127, np.int16))]
    while todo:
        node, rows, rise, fall, low, high = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            found_p.append(rows)
            found_l.append(np.full(len(rows), node, np.int64))
            continue
        d, cut, left, right = node
        x = points[rows, d].astype(np.int16)
        less = fall + np.maximum(x - (cut - 1), 0) - np.maximum(x - high[d], 0)     # into the box below the cut
        more = rise + np.maximum(cut - x, 0) - np.maximum(low[d] - x, 0)
        below, above = high.copy(), low.copy()
        below[d], above[d] = cut - 1, cut
        ok = less <= down
        todo.append((left, rows[ok], rise[ok], less[ok], low, below))
        ok = more <= up
        todo.append((right, rows[ok], more[ok], fall[ok], above, high))
    return np.concatenate(found_p), np.concatenate(found_l)


class Tree:
    """Words of one length: counts in a local k-d tree with tight boxes."""

    def __init__(self, words: list[str], n: np.ndarray):
        codes = letters(words)
        vectors = counts(codes)
        order, self.nodes = [], []
        todo = [(np.arange(len(words)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            if parent is not None:
                self.nodes[parent][2 + side] = len(self.nodes)
            part = vectors[rows]
            self.nodes.append([part.min(axis=0).astype(np.int16), part.max(axis=0).astype(np.int16), -1, -1, len(order), len(rows)])
            cut = best_cut(part) if len(rows) > LEAF else None
            if cut is None:
                order.extend(rows.tolist())
            else:
                below = part[:, cut[0]] < cut[1]
                at = len(self.nodes) - 1
                todo += [(rows[below], at, 0), (rows[~below], at, 1)]
        order = np.array(order, np.int64)
        self.words = [words[i] for i in order]
        self.codes, self.n = codes[order], n[order]
        self.parity = parities(self.codes)

    def near(self, codes: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, word)`` pairs one edit apart."""
        vectors, parity = counts(codes).astype(np.int16), parities(codes)
        out_q, out_w = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        todo = [(0, np.arange(len(codes)))]
        while todo:
            at, rows = todo.pop()
            low, high, left, right, start, size = self.nodes[at]
            x = vectors[rows]
            ok = (np.maximum(low - x, 0).sum(axis=1) <= up) & (np.maximum(x - high, 0).sum(axis=1) <= down)
            rows = rows[ok]
            if not len(rows):
                continue
            if left >= 0:
                todo += [(left, rows), (right, rows)]
                continue
            step = max(1, (1 << 20) // len(rows))
            for a in range(start, start + size, step):
                close = np.bitwise_count(parity[rows][:, None] ^ self.parity[None, a:min(a + step, start + size)]) <= up + down
                q, w = np.nonzero(close)
                q, w = rows[q], w + a
                right_order = self._order(codes, q, w)
                out_q.append(q[right_order])
                out_w.append(w[right_order])
        return np.concatenate(out_q), np.concatenate(out_w)

    def _order(self, codes: np.ndarray, q: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exactly one code point replaced, inserted or deleted?"""
        out = np.zeros(len(q), bool)
        size = max(codes.shape[1], self.codes.shape[1])
        step = max(1, (1 << 21) // size)
        for at in range(0, len(q), step):
            a, b = codes[q[at:at + step]], self.codes[w[at:at + step]]
            if a.shape[1] == b.shape[1]:
                out[at:at + step] = (a != b).sum(axis=1) == 1
                continue
            short, long = (a, b) if a.shape[1] < b.shape[1] else (b, a)
            n = short.shape[1]
            front, back = short != long[:, :n], short != long[:, 1:]
            first = np.where(front.any(axis=1), front.argmax(axis=1), n)
            last = np.where(back.any(axis=1), back[:, ::-1].argmax(axis=1), n)
            out[at:at + step] = first + last >= n
        return out


# ------------------------------------------------------------ Spark jobs

def fit_splits(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, tuple]:
    """Per length a tree of splits from a hash sample of about ``sample`` words."""
    total = words.count()
    part = min(1.0, sample / max(1, total))
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(part * (1 << 20))) if part < 1 else words
    by_length: dict[int, list[str]] = {}
    for row in drawn.select("word").toLocalIterator():
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    out, at = {}, 0
    for size, held in sorted(by_length.items()):
        out[size], at = leaves(split(counts(letters(held)), max(1.0, cell * part)), at)
    return out


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    return {int(k): np.flatnonzero(size == k) for k in np.unique(size)}


def _leaf(trees: dict, size: int):
    """The tree of a length; one without sampled words is a single cell of its own."""
    return trees.get(size, -size)


def _cells(trees):
    def placed(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            cell = np.zeros(len(words), np.int64)
            for size, rows in _by_length(words).items():
                cell[rows] = place(_leaf(trees.value, size), counts(letters([words[i] for i in rows])))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(list(map(len, words)), pa.int64())], ["cell", "size"])
    return placed


def _deal(trees, slots):
    """Every word as a point of its cell and as queries to the cells its edits may reach."""
    import xxhash

    names = ["cell", "slot", "kind", "word", "n"]

    def dealt(batches):
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for size, rows in _by_length(words).items():
                held = [words[i] for i in rows]
                vectors = counts(letters(held))
                cell = place(_leaf(trees.value, size), vectors)
                own = np.array([xxhash.xxh64_intdigest(w.encode(), 7) % slots.value.get(c, 1) for w, c in zip(held, cell.tolist(), strict=True)], np.int64)
                yield _rows(names, cell, own, 0, held, n[rows])
                for k, (longer, up, down) in enumerate(EDITS, 1):
                    if size + longer not in trees.value and size + longer not in slots.value["lengths"]:
                        continue
                    who, to = visits(_leaf(trees.value, size + longer), vectors, up, down)
                    many = np.array([slots.value.get(c, 1) for c in to.tolist()], np.int64)
                    at = np.repeat(np.arange(len(who)), many)
                    slot = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                    for a in range(0, len(at), 1 << 14):
                        cut = slice(a, a + (1 << 14))
                        picked = who[at[cut]]
                        yield _rows(names, to[at[cut]], slot[cut], k, [held[i] for i in picked], n[rows][picked])
    return dealt


def _rows(names, cell, slot, kind, words, n):
    return pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(slot, pa.int64()), pa.array(np.full(len(cell), kind), pa.int32()), pa.array(words, pa.string()),
                                       pa.array(n, pa.int64())], names)


def _search(batches):
    """Rows in order of (cell, slot, kind): the points of a slot, then its queries.
    Points leave with their own count; queries with what they met here."""
    names, types = ["word", "n", "n_near", "best_n", "best"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    key, points, weights, tree = None, [], [], None

    def found(kind, words, n):
        codes = letters(words)
        q, w = tree.near(codes, *EDITS[kind - 1][1:])
        if not len(q):
            return None
        text = [tree.words[i] for i in w]
        rank = np.empty(len(w), np.int64)
        rank[sorted(range(len(w)), key=text.__getitem__)] = np.arange(len(w))
        order = np.lexsort((rank, -tree.n[w], q))
        first = np.flatnonzero(np.diff(q[order], prepend=-1))
        who = q[order][first]
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i in who], types[0]), pa.array(n[who]), pa.array(np.diff(first, append=len(q))),
                                           pa.array(tree.n[w[order][first]]), pa.array([text[i] for i in order[first]], types[0])], names)

    for batch in batches:
        cell, slot, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        words, n = batch.column(3).to_pylist(), batch.column(4).to_numpy(zero_copy_only=False)
        turn = np.flatnonzero((np.diff(cell, prepend=-1 << 62) != 0) | (np.diff(slot, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
        for a, b in zip(turn, np.append(turn[1:], len(cell)), strict=True):
            if (cell[a], slot[a]) != key:
                key, points, weights, tree = (cell[a], slot[a]), [], [], None
            if kind[a] == 0:
                points += words[a:b]
                weights.append(n[a:b])
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(words[a:b], types[0]), pa.array(n[a:b]), pa.array(np.zeros(b - a, np.int64)), none, pa.nulls(b - a, pa.string())], names)
                continue
            if not points:
                continue
            tree = tree or Tree(points, np.concatenate(weights))
            size = len(words[a])
            step = max(1, (1 << 21) // size)
            for at in range(a, b, step):
                out = found(int(kind[a]), words[at:min(b, at + step)], n[at:min(b, at + step)])
                if out is not None:
                    yield out


def near_words(vocab: DataFrame, sample: int = SAMPLE, cell: int = CELL, held: int = HELD) -> DataFrame:
    """``vocab(word, n)``, distinct -> ``word, n, n_near, best_n, best`` for every word."""
    sc = vocab.sparkSession.sparkContext
    trees = fit_splits(vocab, sample, cell)          # at most ``sample`` leaves
    held_trees = sc.broadcast(trees)
    # one row per cell: as many as the trees have leaves, and one per length that the sample lacks
    sizes = vocab.mapInArrow(_cells(held_trees), "cell long, size long").groupBy("cell", "size").agg(F.count("*").alias("n")).collect()
    many = {r["cell"]: m for r in sizes if (m := -(-r["n"] // max(1, max(held // r["size"], 2 * cell if r["size"] < 64 else 1)))) > 1}
    slots = sc.broadcast({**many, "lengths": {r["size"] for r in sizes}})
    dealt = vocab.mapInArrow(_deal(held_trees, slots), "cell long, slot long, kind int, word string, n long")
    met = dealt.repartition("cell", "slot").sortWithinPartitions("cell", "slot", "kind").mapInArrow(_search, "word string, n long, n_near long, best_n long, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), "best")))
    rows = met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return rows.select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``links(word, form)`` without cycles -> ``word, root``, by pointer doubling."""
    now = store(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        to = now.select(F.col("word").alias("root"), F.col("root").alias("on"))
        step = store(now.join(to, "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "forms")
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now


def variants(vocab: DataFrame, factor: int = FACTOR, **sizes) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``vocab(word, n)``."""
    vocab = store(vocab.select("word", "n"), "vocabulary")
    near = store(near_words(vocab, **sizes), "near")
    taken: Column = F.col("best_n") >= factor * F.col("n")
    rows = near.select("word", F.when(taken, F.col("best")).alias("form"), "n", "n_near", F.when(taken, F.col("best_n")).alias("form_n"))
    up = roots(rows.where("form is not null"))
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
