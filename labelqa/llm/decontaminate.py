"""Benchmark decontamination with spaced seeds.

A seed is a mask over consecutive words of which only some positions count;
words at the others may differ. Every benchmark item is hashed under all masks
at all positions, and every document likewise; equal hashes give a diagonal
(item, shift) on which the words are then compared themselves. The overlap is
the longest stretch of the diagonal that begins and ends with an equal word
and in which at least ``identity`` per cent of the words are equal; it counts
as a leak from ``min_words`` words on (or the whole item, if that is shorter).

No overlap that this rule accepts escapes the masks. ``MASKS`` meet every
pattern of equal and unequal words of ``min_words`` to twice as many words
(``complete`` follows all of them), and a longer stretch falls into pieces of
such lengths, of which one at least is as equal as the whole. For other
settings a mask of consecutive words is added, as long as the run that must be
equal. Items of fewer than ``min_words`` words have masks of their own: inner
words are cut into one block more than may differ, and each mask keeps both
ends and one block. Items of one to four words must be equal as they are.

A word is what white space or ASCII punctuation parts. Letters of scripts
without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) are a word each.

The hash table of the benchmark is broadcast in blocks of about ``block_words``
words at most (an item is never cut); the documents are read once for each
block, and the driver makes one block at a time. Documents are never shuffled.
Inside a task, words and hits are taken in slices, so that its memory grows
with a text's number of words, not with words x item.

Defined cases: null or empty text has no leak, null items and items without a
word match nothing, an empty benchmark or table gives no leak; a null
``doc_id`` is carried; repeated rows are each reported; extra columns stay
untouched in ``clean_documents``. Whole texts of any length are scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

IDENTITY, MIN_WORDS = 80, 13
MASKS = ("11010111", "11100010011", "111001000101", "111111")
WORD_BYTES = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
UNSPACED = re.compile("([฀-໿က-႟ក-៿々぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff])|[　-〿！-／：-＠]")
UNSPACED_LEADS = bytes((0xE0, 0xE1, 0xE3, 0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9, 0xEF, 0xF0))     # first bytes of these in UTF-8
SLICE = 1 << 18         # words hashed, pairs expanded at once
PIECE = 1 << 20         # bytes split at once


def word_pieces(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, piece by piece."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    if len(raw.translate(None, UNSPACED_LEADS)) < len(raw):
        raw = UNSPACED.sub(lambda m: f" {m[1] or ''} ", text.lower()).encode("utf-8", "surrogatepass")
    raw, at = raw.translate(WORD_BYTES), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def words_of(text: str) -> list[bytes]:
    return [w for piece in word_pieces(text) for w in piece]


def complete(masks, identity: int = IDENTITY, min_words: int = MIN_WORDS) -> bool:
    """Whether a mask meets every stretch of ``min_words`` words or more of
    which ``identity`` per cent are equal.

    Follows all patterns that no mask meets by their last words (the state)
    and keeps the greatest equal share of each; a pattern of twice the length
    or more falls into two, one of which has at least its share."""
    kept = [(len(m), int(m, 2)) for m in masks]
    state_bits = max(n for n, _ in kept)
    best = {(0, 0): 0}                      # (words so far up to the widest mask, the words as bits): height
    for size in range(1, 2 * min_words):
        further: dict[tuple[int, int], int] = {}
        for (n, bits), height in best.items():
            for equal in (0, 1):
                m, b = min(n + 1, state_bits), (bits << 1 | equal) & ((1 << state_bits) - 1)
                if not any(m >= width and b & mask == mask for width, mask in kept):
                    h = height + (100 - identity if equal else -identity)
                    further[m, b] = max(h, further.get((m, b), h))
        best = further
        if size >= min_words and any(h >= 0 for h in best.values()):
            return False
    return True


def masks_for(identity: int = IDENTITY, min_words: int = MIN_WORDS, masks=MASKS) -> tuple[str, ...]:
    """``masks``, with a run of equal words where they are not complete."""
    if min_words < 1 or not 0 < identity <= 100:
        raise ValueError("min_words from 1, identity in (0, 100]")
    if complete(masks, identity, min_words):
        return tuple(masks)
    runs = []
    for n in range(min_words, 2 * min_words):
        differ = n * (100 - identity) // 100
        runs.append(-(-(n - differ) // (differ + 1)))
    return (*masks, "1" * max(1, min(runs)))


def short_masks(n: int, identity: int = IDENTITY) -> list[str]:
    """Masks of an item of ``n`` words that must be met as a whole."""
    differ = min(n * (100 - identity) // 100, max(0, n - 2))
    if not differ:
        return ["1" * n]
    cuts = [1 + (n - 2) * k // (differ + 1) for k in range(differ + 2)]
    return ["".join("1" if i in (0, n - 1) or a <= i < b else "0" for i in range(n)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(n: int, salt: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


class Seeds:
    """The benchmark items of one block, hashed under every mask."""

    def __init__(self, items: list[tuple[int, str]], masks=MASKS, identity: int = IDENTITY, min_words: int = MIN_WORDS):
        self.identity, self.min_words = identity, min_words
        self.vocabulary: dict[bytes, int] = {}
        self.items, self.ids = [], []
        for item, text in items:
            number = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text or "")]
            if number:
                self.ids.append(item)
                self.items.append(np.array(number, np.int32))
        sizes = {len(x) for x in self.items}
        whole = [(m, n) for n in sorted(sizes) if n < min_words for m in short_masks(n, identity)]
        inner = [(m, 0) for m in masks_for(identity, min_words, masks)] if any(n >= min_words for n in sizes) else []
        self.masks = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == 49) for m, _ in inner + whole]
        self.code = _codes(len(self.vocabulary) + 1, 1)         # the last is that of all other words
        widest = max((int(m[-1]) + 1 for m in self.masks), default=1)
        self.factor, self.salt = _codes(widest, 2) | np.uint64(1), _codes(len(self.masks), 3)
        keys, owner, start = [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for n, words in enumerate(self.items):
            for mask, (_, size) in enumerate(inner + whole):
                if size == (len(words) if len(words) < min_words else 0):
                    hashes = self.hashes(self.code[words], mask)
                    keys.append(hashes)
                    owner.append(np.full(len(hashes), n, np.int32))
                    start.append(np.arange(len(hashes), dtype=np.int32))
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.start = keys[order], np.concatenate(owner)[order], np.concatenate(start)[order]
        self.shift = np.uint64(64 - min(24, max(16, len(keys).bit_length() + 3)))
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[(self.keys >> self.shift).astype(np.int64)] = True

    def hashes(self, code: np.ndarray, mask: int) -> np.ndarray:
        """The hash of every window under one mask."""
        offsets = self.masks[mask]
        n = len(code) - int(offsets[-1])
        if n < 1:
            return np.empty(0, np.uint64)
        total = np.full(n, self.salt[mask], np.uint64)
        for o in offsets:
            total += code[o:o + n] * self.factor[o]
        return total

    def overlap(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """Longest stretch of the diagonal with enough equal words, both ends
        equal: (start in the document, words, equal words); the first of several."""
        wanted = self.items[item]
        lo, hi = max(0, -shift), min(len(wanted), len(words) - shift)
        if hi - lo < min(self.min_words, len(wanted)):
            return None
        equal = wanted[lo:hi] == words[lo + shift:hi + shift]
        height = np.concatenate([[0], np.cumsum(np.where(equal, 100 - self.identity, -self.identity))])
        # for each end, the first start that lies no higher
        lowest = np.minimum.accumulate(np.where(equal, height[:-1], np.iinfo(np.int64).max))
        first = np.searchsorted(-lowest, -height[1:], "left")
        size = np.where(equal, np.arange(1, len(height)) - first, 0)
        end = int(np.argmax(size))
        n = int(size[end])
        if n < max(1, min(self.min_words, len(wanted))):
            return None
        a = end + 1 - n
        return a + lo + shift, n, int(np.count_nonzero(equal[a:end + 1]))

    def numbers(self, text: str) -> np.ndarray:
        """Benchmark numbers of a text's words; -1 for others."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, piece, repeat(-1)), np.int32, len(piece)) for piece in word_pieces(text)]
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def spots(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, shift) of diagonals with an equal hash, of
        texts laid end to end; ``bounds`` are their starts."""
        reach = max((len(x) for x in self.items), default=0)
        wide = len(words) + reach + 1
        many = len(self.items)
        seen = np.empty(0, np.int64)
        for a in range(0, len(words), SLICE):
            for mask, offsets in enumerate(self.masks):
                hashes = self.hashes(self.code[words[a:a + SLICE + int(offsets[-1])]], mask)
                hashes = hashes[:SLICE]
                maybe = np.flatnonzero(self.known[(hashes >> self.shift).astype(np.int64)])
                lo, hi = (np.searchsorted(self.keys, hashes[maybe], side) for side in ("left", "right"))
                hit = np.flatnonzero(hi > lo)
                at, lo, n = maybe[hit] + a, lo[hit], (hi - lo)[hit]
                ends = np.cumsum(n)
                k = 0
                while k < len(at):              # a slice of pairs at a time
                    to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + SLICE, "right")))
                    each = n[k:to]
                    where = np.repeat(lo[k:to] - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
                    here = np.repeat(at[k:to], each)
                    text = np.searchsorted(bounds, here, "right") - 1
                    seen = np.union1d(seen, (text * many + self.owner[where]) * wide + (here - self.start[where] + reach))
                    k = to
        return np.stack([seen // wide // many, seen // wide % many, seen % wide - reach], axis=1)

    def leaks(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per text (item id, first word in the document, words, equal words)."""
        out: list[list] = [[] for _ in texts]
        if not len(self.keys):
            return out
        held, total = [], 0
        for k, text in enumerate(texts):
            words = self.numbers(text) if text else np.empty(0, np.int32)
            held.append((k, words))
            total += len(words)
            if total >= SLICE or k == len(texts) - 1:
                self._settle(held, out)
                held, total = [], 0
        return [sorted(x, key=lambda y: (y[1], str(y[0]), y[2])) for x in out]

    def _settle(self, held: list[tuple[int, np.ndarray]], out: list[list]) -> None:
        held = [(k, w) for k, w in held if len(w)]
        if not held:
            return
        bounds = np.cumsum([0] + [len(w) for _, w in held[:-1]])
        found = [set() for _ in held]
        for text, item, shift in self.spots(np.concatenate([w for _, w in held]), bounds).tolist():
            hit = self.overlap(held[text][1], item, shift - int(bounds[text]))
            if hit:
                found[text].add((self.ids[item], *hit))
        for (k, _), hits in zip(held, found, strict=True):
            out[k].extend(hits)


def seed_blocks(benchmark: DataFrame, block_words: int = 500_000, **seeds) -> Iterator[Seeds]:
    """The benchmark as broadcastable blocks of at most about ``block_words``
    words, or one item; made one after the other."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // (2 * block_words)))     # two bytes a word at the least
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        yield Seeds([(r["item_id"], r["text"]) for r in items.where(part == k).orderBy("item_id", "text").collect()], **seeds)


LEAK = pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("n_equal", pa.int64())])


def _scan(shared):
    @F.arrow_udf("array<struct<item_id:long,start_word:long,n_words:long,n_equal:long>>")
    def scan(texts: pa.Array) -> pa.Array:
        names = [f.name for f in LEAK]
        return pa.array([[dict(zip(names, x, strict=True)) for x in hits] for hits in shared.value.leaks(texts.to_pylist())], pa.list_(LEAK))

    return scan


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per overlap: ``doc_id, item_id, start_word, n_words, n_equal``."""
    parts = []
    for block in seed_blocks(benchmark, **options):
        scan = _scan(docs.sparkSession.sparkContext.broadcast(block))
        parts.append(docs.select("doc_id", F.explode(scan(text_of())).alias("leak")).select("doc_id", "leak.*"))
    return reduce(DataFrame.union, parts)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a leak, all columns as they came; no shuffle."""
    for block in seed_blocks(benchmark, **options):
        scan = _scan(docs.sparkSession.sparkContext.broadcast(block))
        docs = docs.where(F.size(scan(text_of())) == 0)
    return docs
