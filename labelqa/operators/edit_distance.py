"""D5 with E3: edit distance of joined page texts, neither text ever in one row.

First each page is compared with the page of the same number on the other side, all
pages at once. The sum over a document's pages is the cost of one way to edit the
text, so the distance is no more; it is no less than the difference of the lengths.
Where both are the same number, as where signs, lines or whole pages are missing on
one side only, that is the distance. The other documents are compared as a whole:

The table of the distance is cut into blocks of ``block`` x ``block`` characters.
A block needs its two pieces of text and the last row and column of the blocks
above and to the left, so blocks with equal ``i + j`` are computed together: one
round per such diagonal, for all documents at once, each round stored before the
next one reads it (a lost executor repeats one round at most). Neighbours along an
edge differ by at most one, so an edge travels as the number at its corner and two
bits per character, and a block is computed a row at a time on such bit vectors
(Myers' bit-parallel recurrence, over Python integers of ``block`` bits).

Only blocks in a strip are computed: those between the first diagonal and the one
of the last characters, and ``margin`` more on either side. The difference of the
lengths is spent on any way, and leaving the strip costs over ``2 * margin * block``
edits more, so a distance up to that is exact; else it is an upper bound, and the
document is computed again with a margin up to four times as wide, no wider than
that bound or the pages' asks for. Work is ``length * distance``, memory of a task a
few edges and two pieces. A round is a Spark job of its own, so blocks are long and
rounds few.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, ensure_checkpoint_dir
from .layout import page_spans

BLOCK = 65_536
WHOLE = 4096                # texts up to this length are compared whole, longer pages in parts
STRETCH = 32                # signs of a stretch at which a long page is cut
MARGIN = 4                  # blocks; a wider margin is not taken on the word of the pages' bound alone
_ROUND = "key long, i long, j long, side string, corner long, plus binary, minus binary, distance long"
_ROUND_ARROW = pa.schema([("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("side", pa.string()), ("corner", pa.int64()),
                          ("plus", pa.binary()), ("minus", pa.binary()), ("distance", pa.int64())])


def _page_texts(pages: DataFrame, doc: str, seq: str, text: str, sep: str) -> DataFrame:
    """``(doc, start_pos, body)``: what each page gives to the joined text, its
    separator with it. Pages that give nothing are left out."""
    spans = page_spans(pages, doc, seq, text, sep)
    spans = spans.select(F.col(doc).alias("__d"), F.col(seq).alias("__s"), "start_pos", "page_no", "n_pages")
    rows = pages.join(spans, pages[doc].eqNullSafe(spans["__d"]) & pages[seq].eqNullSafe(spans["__s"]))
    body = F.concat(F.coalesce(pages[text], F.lit("")), F.when(F.col("page_no") < F.col("n_pages"), F.lit(sep)).otherwise(F.lit("")))
    return rows.select(F.col("__d").alias(doc), "start_pos", body.alias("body")).where(F.length("body") > 0)


def _cut(rows: DataFrame, doc: str, block: int) -> DataFrame:
    first, last = F.floor(F.col("start_pos") / block), F.floor((F.col("start_pos") + F.length("body") - 1) / block)
    cut = rows.select(doc, "start_pos", "body", F.explode(F.sequence(first, last)).alias("i"))
    begin = F.greatest(F.lit(0), F.col("i") * block - F.col("start_pos"))
    end = F.least(F.length("body"), (F.col("i") + 1) * block - F.col("start_pos"))
    part = F.substr("body", (begin + 1).cast("int"), (end - begin).cast("int"))
    parts = cut.select(doc, "i", F.struct(F.col("start_pos"), part.alias("part")).alias("p"))
    # at most `block` characters meet per (document, i)
    return parts.groupBy(doc, "i").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("p")), lambda p: p["part"]), "").alias("piece"))


def text_blocks(pages: DataFrame, doc: str, seq: str, text: str, sep: str = " ", block: int = BLOCK) -> DataFrame:
    """``(doc, i, piece)``: the joined page text of a document, cut at multiples
    of ``block`` code points. A null text counts as empty."""
    return _cut(_page_texts(pages, doc, seq, text, sep), doc, block)


def whole_distance(a: str, b: str) -> int:
    """Edit distance of two texts that are not empty, by Myers' recurrence."""
    a, b = sorted((a, b), key=len)
    places: dict[str, int] = {}
    for k, char in enumerate(b):
        places[char] = places.get(char, 0) | 1 << k
    every, last, distance = (1 << len(b)) - 1, 1 << len(b) - 1, len(b)
    plus, minus = every, 0
    for char in a:
        equal = places.get(char, 0)
        across = equal | minus
        along = (((equal & plus) + plus) ^ plus) | equal
        grow = minus | (every & ~(along | plus))
        shrink = plus & along
        distance += 1 if grow & last else -1 if shrink & last else 0
        grow, shrink = grow << 1 | 1, shrink << 1
        plus = (shrink | ~(across | grow)) & every
        minus = grow & across
    return distance


def near_distance(a: str, b: str) -> int | None:
    """Edit distance of two texts, or None where it takes too long this way. Edits beyond
    the difference of the lengths are allowed one by one; kept is the furthest place in
    the longer text on each diagonal. An edit towards the last diagonal adds nothing
    beyond the difference, one away from it adds two, another sign in place adds one."""
    a, b = sorted((a, b), key=len, reverse=True)
    goal, left = len(a) - len(b), 4 * len(a)
    two, one, beyond = {}, {}, 0
    while left > 0:
        now: dict[int, int] = {}
        wide = beyond // 2
        for k in (*range(-wide, goal), *range(goal + wide, goal - 1, -1)):
            x = one.get(k, -1) + 1
            x = max(x, (now if k <= goal else two).get(k - 1, -1) + 1, (now if k >= goal else two).get(k + 1, 0))
            x = began = max(min(x, len(a), len(b) + k), k, 0)
            y = x - k
            while x < len(a) and y < len(b) and a[x] == b[y]:
                x, y = x + 1, y + 1
            now[k] = x
            left -= 8 + x - began
            if left <= 0:
                return None
        if now[goal] == len(a):
            return goal + beyond
        two, one, beyond = one, now, beyond + 1
    return None


def _meeting(a: str, b: str) -> tuple[int, int]:
    """Where two long texts are cut: at a stretch that each of them has once, else half way."""
    short, long = sorted((a, b), key=len)
    for eighths in (4, 2, 6, 1, 3, 5, 7):
        at = len(short) * eighths // 8
        stretch = short[at:at + STRETCH]
        there = long.find(stretch)
        if at and there >= 0 and there == long.rfind(stretch) and at == short.find(stretch) == short.rfind(stretch):
            return (at, there) if short is a else (there, at)
    return len(a) // 2, len(b) // 2


def page_bound(a: str, b: str) -> int:
    """The edit distance of two pages of up to ``WHOLE`` characters or with few edits; an upper
    bound for others, which are cut until each part is that short, whatever the cuts."""
    todo, bound = [(a, b)], 0
    while todo:
        a, b = todo.pop()
        same = len(os.path.commonprefix((a, b)))
        a, b = a[same:], b[same:]
        same = len(os.path.commonprefix((a[::-1], b[::-1])))
        a, b = a[:len(a) - same], b[:len(b) - same]
        if not a or not b:
            bound += len(a) + len(b)
        elif (near := near_distance(a, b)) is not None:
            bound += near
        elif len(a) * len(b) <= WHOLE * WHOLE:
            bound += whole_distance(a, b)
        else:
            i, j = _meeting(a, b)
            todo += [(a[:i], b[:j]), (a[i:], b[j:])]
    return bound


@F.arrow_udf(T.LongType())
def _page_bounds(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else page_bound(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int64())


def _documents(left: DataFrame, right: DataFrame, doc: str, seq: str, text: str, sep: str, block: int) -> DataFrame:
    """``(__doc, left_chars, right_chars, bound, times)`` for every document. ``bound`` is what it
    costs to edit each page into the page of the same number; a page that only one side
    has is left out, and its separator. (A separator after the last page, on both sides,
    changes no distance.) A page longer than a block counts in full, unless both are
    equal. ``times``: how often a number comes on one side; beyond 1 the rest is void."""
    types = {s.schema[seq].dataType.simpleString() for s in (left, right)}
    # numbers of two types may differ in order: no page meets another then
    pages = ["__page"] * 2 if len(types) == 1 else ["__left", "__right"]
    sides = [s.select(F.col(doc).alias("__doc"), F.col(seq).alias(page), F.coalesce(F.col(text), F.lit("")).alias(side))
             for s, page, side in zip((left, right), pages, "ab", strict=True)]
    pairs = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy("__doc", *dict.fromkeys(pages)).agg(
        F.max("a").alias("a"), F.max("b").alias("b"), F.greatest(F.count("a"), F.count("b")).alias("times"))
    longest = F.greatest(F.length("a"), F.length("b"))      # of one text, if the other is null
    hard = (F.col("a") != F.col("b")) & (F.length("a") > 0) & (F.length("b") > 0) & (longest <= block)
    known = F.when(F.col("a") == F.col("b"), F.lit(0)).when(F.col("a").isNull() | F.col("b").isNull(), longest + len(sep)).otherwise(longest)
    cost = F.coalesce(_page_bounds(F.when(hard, F.col("a")), F.when(hard, F.col("b"))), known)
    pairs = pairs.select("__doc", "times", cost.cast("long").alias("cost"), *((F.length(side) + len(sep)).cast("long").alias(side) for side in "ab"))
    chars = [F.coalesce(F.sum(side) - len(sep), F.lit(0)).alias(name) for side, name in (("a", "left_chars"), ("b", "right_chars"))]
    return pairs.groupBy("__doc").agg(*chars, F.sum("cost").alias("bound"), F.max("times").alias("times"))


def _places(chars: np.ndarray, wanted: np.ndarray) -> dict[int, int]:
    """For each wanted code point, the positions that hold it, as bits."""
    return {int(c): int.from_bytes(np.packbits(chars == c, bitorder="little").tobytes(), "little") for c in np.intersect1d(chars, wanted)}


def block_edges(a: str, b: str, top: tuple[int, int], left: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
    """Last row and last column of a block from its texts and its first row and
    column. An edge is two bit vectors: steps of +1, steps of -1 (else 0)."""
    rows, cols = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    places, last, every = _places(cols, rows), len(cols) - 1, (1 << len(cols)) - 1
    plus, minus = top
    right_plus, right_minus = bytearray(len(rows)), bytearray(len(rows))
    down, up = (np.unpackbits(np.frombuffer(v.to_bytes((len(rows) + 7) // 8, "little"), np.uint8), bitorder="little") for v in left)
    for k, char in enumerate(rows.tolist()):
        equal, falls, rises = places.get(char, 0), int(up[k]), int(down[k])
        across = equal | minus
        equal |= falls
        along = (((equal & plus) + plus) ^ plus) | equal
        grow = minus | (every & ~(along | plus))
        shrink = plus & along
        right_plus[k], right_minus[k] = grow >> last & 1, shrink >> last & 1
        grow, shrink = (grow << 1 | rises) & every, (shrink << 1 | falls) & every
        plus = shrink | (every & ~(across | grow))
        minus = grow & across
    right = tuple(int.from_bytes(np.packbits(np.frombuffer(r, np.uint8), bitorder="little").tobytes(), "little") for r in (right_plus, right_minus))
    return (plus, minus), right


def _edge(plus: bytes | None, minus: bytes | None, size: int) -> tuple[int, int]:
    """An edge as stored. A border of the table grows by one a step; so does the
    bound that an edge outside the band is given, a path along that edge."""
    if plus is None:
        return (1 << size) - 1, 0
    return int.from_bytes(plus, "little"), int.from_bytes(minus, "little")


def _sum(edge: tuple[int, int]) -> int:
    return edge[0].bit_count() - edge[1].bit_count()


def _stored(edge: tuple[int, int], size: int) -> tuple[bytes, bytes]:
    return tuple(v.to_bytes((size + 7) // 8, "little") for v in edge)


def _compute(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            key, i, j, a, b = (r[c] for c in ("key", "i", "j", "a", "b"))
            top, left = _edge(r["top_plus"], r["top_minus"], len(b)), _edge(r["left_plus"], r["left_minus"], len(a))
            corner = r["corner"] if r["corner"] is not None else 0      # only the first block has no edge before it
            bottom, right = block_edges(a, b, top, left)
            below = corner + _sum(left)
            if i == r["ni"] - 1 and j == r["nj"] - 1:
                rows = [(key, i, j, "done", None, None, None, below + _sum(bottom))]
            else:
                rows = [(key, i + 1, j, "top", below, *_stored(bottom, len(b)), None),
                        (key, i, j + 1, "left", corner + _sum(top), *_stored(right, len(a)), None)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROUND_ARROW, strict=True)],
                                             schema=_ROUND_ARROW)


def _banded(docs: DataFrame, a: DataFrame, b: DataFrame, rounds: int, below: int, after: int) -> DataFrame:
    """``(key, distance)`` over the blocks of each document's strip, ``below`` blocks under
    the diagonal and ``after`` blocks over it; the numbers given are the largest of any."""
    spark = docs.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), f"edit-distance-{uuid.uuid4().hex}")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = spark.createDataFrame([], _ROUND)
    for r in range(rounds):
        low, high = max(0, (r - after + 1) // 2), min(r, (r + below) // 2)
        blocks = (docs.where(F.col("ni") + F.col("nj") > r)
                  .select("*", F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))).alias("i"))
                  .withColumn("j", F.lit(r) - F.col("i"))
                  .where((F.col("i") < F.col("ni")) & (F.col("j") < F.col("nj"))
                         & (F.col("i") - F.col("j")).between(-F.col("after"), F.col("below"))))
        sides = [F.max(F.when(F.col("side") == side, F.col(bits))).alias(f"{side}_{bits}") for side in ("top", "left") for bits in ("plus", "minus")]
        # both edges of a block start at the same corner
        had = edges.where("side <> 'done'").groupBy("key", "i", "j").agg(F.max("corner").alias("corner"), *sides)
        # pieces of this diagonal only: the ranges reach the scan
        mine = a.where(F.col("i").between(low, high)).withColumnRenamed("piece", "a")
        its = b.where(F.col("i").between(r - high, r - low)).select("key", F.col("i").alias("j"), F.col("piece").alias("b"))
        work = blocks.join(had, ["key", "i", "j"], "left").join(mine, ["key", "i"], "left").join(its, ["key", "j"], "left")
        # a block is few bytes and much work: as many tasks as asked for, not merged by size
        work = work.select(*blocks.columns, *had.columns[3:], "a", "b").repartition(tasks, "key", "i")
        path = f"{base}/round={r}"
        work.mapInArrow(_compute, _ROUND).write.parquet(path)
        edges = spark.read.schema(_ROUND).parquet(path)
    return spark.read.schema(_ROUND).parquet(*[f"{base}/round={r}" for r in range(rounds)]).where("side = 'done'").select("key", "distance")


def joined_text_scores(left: DataFrame, right: DataFrame, doc: str, seq: str, text: str,
                       sep: str = " ", block: int = BLOCK) -> DataFrame:
    """``(doc, left_chars, right_chars, distance, score)`` for every document of
    either side: the pages' texts joined in order, compared as E3 does
    (``similarity``). A side without the document is an empty text; ``seq`` is
    unique per document; a null ``doc`` is a document of its own."""
    every = _documents(left, right, doc, seq, text, sep, block).withColumn("key", F.monotonically_increasing_id())
    longest, longer = F.greatest("left_chars", "right_chars"), F.col("left_chars") - F.col("right_chars")
    settled = (F.col("times") == 1) & (F.least("bound", longest) == F.abs(longer))
    every = durable(every.withColumn("settled", settled), "documents")      # a document's number is settled here
    rest, every = every.where("not settled"), every.where("settled").select("__doc", "key", "left_chars", "right_chars")
    found = []
    todo = None
    if not rest.isEmpty():
        keys = rest.select("__doc", "key")
        sides = [s.join(keys, s[doc].eqNullSafe(keys["__doc"]), "left_semi") for s in (left, right)]
        sides = [durable(_page_texts(s, doc, seq, text, sep), "page-texts") for s in sides]
        sides = [s.join(keys, s[doc].eqNullSafe(keys["__doc"])).select("key", "start_pos", "body") for s in sides]
        rest = rest.drop("left_chars", "right_chars")
        for name, s in zip(("left_chars", "right_chars"), sides, strict=True):
            rest = rest.join(s.groupBy("key").agg(F.sum(F.length("body")).alias(name)), "key", "left").fillna(0, [name])
        rest = rest.withColumn("bound", F.when(F.col("times") == 1, F.least("bound", longest)).otherwise(longest)).withColumn("longer", longer)
        rest = durable(rest.withColumn("ni", F.ceil(F.col("left_chars") / block)).withColumn("nj", F.ceil(F.col("right_chars") / block)), "documents")
        every = every.unionByName(rest.select(*every.columns))
        a, b = (durable(_cut(s, "key", block), "text-blocks") for s in sides)
        needed = F.greatest(F.lit(1), F.ceil((F.col("bound") - F.abs("longer")) / (2 * block)))
        margin = F.when(needed <= MARGIN, needed).otherwise(F.lit(1))
        todo = durable(rest.where("ni > 0 and nj > 0").select("key", "ni", "nj", "longer", "bound", margin.alias("margin")), "documents")
    while todo is not None:
        strip = todo.select("*", *((F.col("margin") + F.ceil(F.greatest(F.lit(0), d) / block)).alias(side)
                                   for side, d in (("below", F.col("longer")), ("after", -F.col("longer")))))
        most = strip.agg(F.max(F.col("ni") + F.col("nj") - 1).alias("rounds"), F.max("below").alias("below"), F.max("after").alias("after")).first()
        if most["rounds"] is None:
            break
        got = durable(todo.join(_banded(strip, a, b, most["rounds"], most["below"], most["after"]), "key"), "distances")
        over = F.least("distance", "bound") - F.abs("longer")
        exact = (over <= 2 * F.col("margin") * block) | (F.col("margin") >= F.greatest("ni", "nj"))
        found.append(got.where(exact).select("key", "distance"))
        wider = F.least(F.col("margin") * 4, F.ceil(over / (2 * block)))
        todo = durable(got.where(~exact).select("key", "ni", "nj", "longer", "bound", wider.alias("margin")), "documents")
    out = every
    if found:
        all_found = found[0]
        for f in found[1:]:
            all_found = all_found.unionByName(f)
        out = every.join(all_found, "key", "left")
    else:
        out = every.withColumn("distance", F.lit(None).cast("long"))
    distance = F.coalesce("distance", F.abs(longer))       # settled by the pages, or one side is empty
    score = F.when((longest == 0) | (distance == 0), F.lit(100.0)).otherwise((F.lit(1.0) - distance / longest) * F.lit(100.0))
    return out.select(F.col("__doc").alias(doc), "left_chars", "right_chars", distance.alias("distance"), score.alias("score"))
