"""E9 for a table of patterns: which literal words and phrases does a text hold?

One automaton (Aho-Corasick) per block of patterns reads a text once, whatever the
number of patterns; a hit counts where no word character stands before or after
it, as in ``scoring.word_pattern``. Texts are not shuffled. The pattern table may
be of any size: it is dealt into blocks of at most ``block_chars`` characters,
checked before they are broadcast, and each block is one pass over the texts.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

BLOCK_CHARS = 2_000_000     # three nodes of the automaton per character at most


# Marks of the places where a pattern may start and end. Half surrogates: no text holds one.
_START, _END = "\ud800", "\udbff"
_OTHER = re.compile(r"(\W)")     # Python's \w is the categories L and N and "_"


def _marked(text: str) -> str:
    """The text with a start mark after and an end mark before each character that is
    no word character, and at its ends. A pattern, marked alike, is a part of a marked
    text exactly where no word character stands before or after it."""
    return _START + _OTHER.sub(_END + r"\1" + _START, text) + _END


def automaton_of(patterns: list[str]):
    import ahocorasick
    found = ahocorasick.Automaton()
    for p in patterns:
        found.add_word(_marked(p), p)
    found.make_automaton()
    return found


def hits_of(text: str, automaton) -> dict[str, int]:
    """Occurrences of each pattern in one text, overlapping ones included."""
    return Counter([p for _, p in automaton.iter(_marked(text))])


def _blocks(patterns: DataFrame, pattern: str, block_chars: int) -> tuple[DataFrame, int]:
    """Distinct patterns with their block, and the number of blocks."""
    known = durable(patterns.select(F.col(pattern).alias("pattern")).where(F.length("pattern") > 0).distinct(), "patterns")
    size = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("pattern")).alias("chars")).first()
    n = 1 if (size["chars"] or 0) <= block_chars else -(-2 * size["chars"] // block_chars)
    while True:
        dealt = known.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(n)))
        widest = dealt.groupBy("block").agg(F.sum(F.length("pattern")).alias("chars"), F.count(F.lit(1)).alias("n"))
        # a block over the bound holds more than one pattern: deal again, finer
        if widest.where((F.col("chars") > block_chars) & (F.col("n") > 1)).isEmpty():
            return dealt, n
        n *= 2


def pattern_hits(docs: DataFrame, key: str, text: str, patterns: DataFrame, pattern: str,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(key, pattern, n)`` for every distinct pattern that occurs in a text, ``n``
    times. Null and empty patterns occur nowhere, a null text holds none. Rows of
    a repeated ``key`` are texts of their own."""
    kind = docs.schema[key].dataType.simpleString()
    return _by_block(docs.select(key, text).where(F.col(text).isNotNull()), patterns, pattern, block_chars, _scan,
                     f"`{key}` {kind}, pattern string, n long")


def _by_block(rows: DataFrame, patterns: DataFrame, pattern: str, block_chars: int, scan, schema: str) -> DataFrame:
    """The rows that ``scan`` finds with each block of the patterns, together."""
    spark = rows.sparkSession
    dealt, n = _blocks(patterns, pattern, block_chars)
    out = None
    for b in range(n):
        words = [r["pattern"] for r in dealt.where(F.col("block") == b).select("pattern").collect()]   # at most block_chars
        if words:
            part = rows.mapInArrow(scan(spark.sparkContext.broadcast(words)), schema)
            out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _scan(words):
    def run(batches):
        automaton = automaton_of(words.value)       # once per task
        for batch in batches:
            texts = batch.column(1)
            for at in range(batch.num_rows):
                counts = hits_of(texts[at].as_py(), automaton)
                if counts:
                    keys = batch.column(0).take(pa.array([at] * len(counts), pa.int32()))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                                     names=[batch.schema.names[0], "pattern", "n"])
    return run


def _count(words):
    def run(batches):
        automaton = automaton_of(words.value)       # once per task
        texts, hits = Counter(), Counter()          # a number per pattern of the block at most
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = hits_of(text, automaton)
                texts.update(found.keys())
                hits.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64()),
                                          pa.array([hits[p] for p in texts], pa.int64())], names=["pattern", "n_texts", "n_hits"])
    return run


def pattern_counts(docs: DataFrame, key: str, text: str, patterns: DataFrame, pattern: str,
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(pattern, n_texts, n_hits)`` for every distinct pattern, 0 where none holds it.
    Counted within each task, so a row per task and pattern travels, not one per text."""
    found = _by_block(docs.select(text).where(F.col(text).isNotNull()), patterns, pattern, block_chars, _count,
                      "pattern string, n_texts long, n_hits long")
    found = found.groupBy("pattern").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_hits").alias("n_hits"))
    every = patterns.select(F.col(pattern).alias("pattern")).where(F.length("pattern") > 0).distinct()
    return every.join(found, "pattern", "left").fillna(0, ["n_texts", "n_hits"])
