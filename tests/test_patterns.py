"""A table of patterns against one regular expression per pattern."""

import random
import re
import unicodedata

import regex

from labelqa.operators import patterns as pt
from labelqa.operators.scoring import word_pattern


def _want(text, p):
    return len(regex.findall(r"(?<![\p{L}\p{N}_])" + regex.escape(p) + r"(?![\p{L}\p{N}_])", text, overlapped=True))


TEXTS = ["Ammonium Phosphate 25 %", "ammonium", "a a a a", "été d'été", "x_y x y", "CAUTION: 25kg", "", None, "(a)", "½ a½ a", "!! ?!!", "日本 日本語", "a" * 5000]
WORDS = ["Ammonium", "Phosphate", "Phosphate 25", "25", "a", "a a", "a a a", "été", "d'été", "x", "x y", "x_y", "CAUTION:", "CAUTION", "(a)", "½", "!!", "日本",
         "日本語", "", None, "a", "absent", "a" * 5000]


def test_equals_one_expression_per_pattern(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string")
    known = spark.createDataFrame([(w,) for w in WORDS], "w string")
    want = sorted((i, p, _want(t, p)) for i, t in enumerate(TEXTS) if t for p in {w for w in WORDS if w} if _want(t, p))
    for chars in (pt.BLOCK_CHARS, 2000):       # one block, and many
        assert sorted(map(tuple, pt.pattern_hits(docs, "id", "body", known, "w", block_chars=chars).collect())) == want
    totals = {r["pattern"]: (r["n_texts"], r["n_hits"]) for r in pt.pattern_counts(docs, "id", "body", known, "w").collect()}
    assert set(totals) == {w for w in WORDS if w} and totals["absent"] == (0, 0) and totals["a a"] == (1, 3)


def test_presence_equals_the_word_pattern(spark):
    rnd = random.Random(3)
    docs = spark.createDataFrame([(i, "".join(rnd.choices("ab 1_-é", k=30))) for i in range(50)], "id int, pattern string")
    words = sorted({"".join(rnd.choices("ab1é", k=rnd.randint(1, 2))) for _ in range(8)})
    known = spark.createDataFrame([(w,) for w in words], "w string")
    got = {(r[0], r[1]) for r in pt.pattern_hits(docs, "id", "pattern", known, "w").collect()}
    assert got == {(r["id"], w) for w in words for r in docs.where(docs["pattern"].rlike(word_pattern(w))).collect()}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "id long, t string")
    none = spark.createDataFrame([], "w string")
    assert pt.pattern_hits(docs, "id", "t", none, "w").collect() == []
    assert pt.pattern_counts(docs.where("false"), "id", "t", spark.createDataFrame([("a",)], "w string"), "w").collect() == [("a", 0, 0)]


def test_word_characters():
    """The marks of ``_marked`` rest on Python's word characters being those of ``word_pattern``."""
    assert all((re.match(r"\w", chr(c)) is not None) == (chr(c) == "_" or unicodedata.category(chr(c))[0] in "LN") for c in range(0x110000))


def test_automaton_stops_only_at_whole_words():
    """Places inside words cost nothing: the automaton itself finds only hits that count."""
    automaton = pt.automaton_of(["a", "a b", "!"])
    assert [p for _, p in automaton.iter(pt._marked("banana a b aa !! a"))] == ["a", "a b", "!", "!", "a"]
    assert pt.hits_of("aaaa ba ab", automaton) == {}


def test_counts_travel_by_task(spark):
    """A task sends a row per pattern, however many texts hold it."""
    docs = spark.createDataFrame([(i, "a b a") for i in range(400)], "id long, t string").repartition(2)
    known = spark.createDataFrame([("a",), ("b",), ("a b",), ("c",)], "w string")
    got = pt.pattern_counts(docs, "id", "t", known, "w")
    assert sorted(map(tuple, got.collect())) == [("a", 400, 800), ("a b", 400, 400), ("b", 400, 400), ("c", 0, 0)]
    found = pt._by_block(docs.select("t"), known, "w", pt.BLOCK_CHARS, pt._count, "pattern string, n_texts long, n_hits long")
    assert found.count() == 6
