"""Distances over blocks equal the plain recurrence, whatever block size and band."""

import random

import numpy as np
from pyspark.sql import functions as F

from labelqa.operators import edit_distance, layout


def _plain(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def _pages(spark, docs):
    rows = [(d, k, t) for d, pages in docs.items() for k, t in enumerate(pages)]
    return spark.createDataFrame(rows, "doc string, seq int, text string")


def _steps(edge, size):
    return [(edge[0] >> k & 1) - (edge[1] >> k & 1) for k in range(size)]


def test_block_edges():
    rnd = random.Random(5)
    for _ in range(60):
        a, b, c, d = ("".join(rnd.choices("abé😀", k=rnd.randint(1, 12))) for _ in range(4))
        # the last of four blocks: its first row and column come from the others
        whole = [[_plain((a + c)[:x], (b + d)[:y]) for y in range(len(b + d) + 1)] for x in range(len(a + c) + 1)]
        border = [((1 << n) - 1, 0) for n in map(len, (a, b, c, d))]
        bottom, right = edit_distance.block_edges(a, b, border[1], border[0])
        below, after = edit_distance.block_edges(c, b, bottom, border[2]), edit_distance.block_edges(a, d, border[3], right)
        last_row, last_column = edit_distance.block_edges(c, d, after[0], below[1])
        assert _steps(last_row, len(d)) == list(np.diff(whole[-1][len(b):]))
        assert _steps(last_column, len(c)) == list(np.diff([row[-1] for row in whole[len(a):]]))


def test_pieces_make_the_joined_text(spark):
    pages = _pages(spark, {"d": ["abcdefghij", None, "", "é😀", "x" * 25], "e": [""], None: ["n", "m"], "f": [None, "z"]})
    pieces = edit_distance.text_blocks(pages, "doc", "seq", "text", block=4)
    got: dict = {}
    for r in sorted(pieces.collect(), key=lambda r: r["i"]):
        assert len(r["piece"]) <= 4
        got[r["doc"]] = got.get(r["doc"], "") + r["piece"]
    want = {r["doc"]: r["text"] for r in layout.join_page_texts(pages, "doc", "seq", "text").collect() if r["text"]}
    assert got == want


def test_equals_the_recurrence(spark):
    rnd = random.Random(7)

    def pages(n):
        return ["".join(rnd.choices("ab c", k=rnd.randint(0, 12))) for _ in range(n)]

    left = {"same": pages(5), "near": pages(8), "far": pages(6), "short": ["ab"], "long": pages(9), "only left": ["abc"],
            "empty": [""], "no text": [None], None: ["null", "key"], "shifted": ["0123456789" * 6]}
    right = {"same": left["same"], "near": [t.replace("a", "", 1) for t in left["near"]], "far": ["z" * 20, "y" * 17], "short": pages(9),
             "long": ["b"], "only right": ["xy", "z"], "empty": ["abc"], "no text": [None], None: ["null", "kez"], "shifted": ["456789" + "0123456789" * 5]}
    got = edit_distance.joined_text_scores(_pages(spark, left), _pages(spark, right), "doc", "seq", "text", block=8).collect()
    assert len(got) == len({*left, *right})
    for r in got:
        a, b = (" ".join(t or "" for t in side.get(r["doc"], [])) for side in (left, right))
        d, longest = _plain(a, b), max(len(a), len(b))
        assert (r["left_chars"], r["right_chars"], r["distance"]) == (len(a), len(b), d), r["doc"]
        assert r["score"] == ((1 - d / longest) * 100 if longest and d else 100.0)


def test_no_documents(spark):
    none = _pages(spark, {"d": ["x"]}).where(F.lit(False))
    assert edit_distance.joined_text_scores(none, none, "doc", "seq", "text").collect() == []


def test_strip_lies_between_the_diagonals(spark):
    """A text with a third left out: blocks on the side away from the difference are not computed."""
    import glob
    import os

    from labelqa.session import ensure_checkpoint_dir
    rnd = random.Random(11)
    text = "".join(rnd.choices("abcdefgh", k=240))
    known = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/edit-distance-*"))
    for a, b in ((text, text[:80] + text[160:]), (text[:80] + text[160:], text)):
        got = edit_distance.joined_text_scores(_pages(spark, {"d": [a]}), _pages(spark, {"d": [b]}), "doc", "seq", "text", block=8).collect()
        assert [r["distance"] for r in got] == [_plain(a, b)] == [80]
    new = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/edit-distance-*")) - known
    assert len(new) == 2                       # one pass each
    for path in new:
        rounds = [p for p in glob.glob(f"{path}/round=*") if os.path.isdir(p)]
        blocks = spark.read.parquet(*rounds).select("key", "i", "j", "side").where("side <> 'left'").count()
        assert blocks <= 30 * 13               # 10 blocks apart, one more on either side; 21 wide before


def _rounds(spark):
    import glob

    from labelqa.session import ensure_checkpoint_dir
    return set(glob.glob(f"{ensure_checkpoint_dir(spark)}/edit-distance-*"))


def test_pages_that_lack_something_on_one_side_need_no_rounds(spark):
    """Signs, ends and whole pages left out on one side: the pages' sum is the difference of the lengths."""
    rnd = random.Random(13)
    full = ["".join(rnd.choices("abc dé😀", k=rnd.randint(8, 15))) for _ in range(24)]
    less = [t.replace("a", "") if k % 4 == 0 else t[2:] if k % 4 == 1 else "" if k % 4 == 2 else t for k, t in enumerate(full)]
    docs = [(("a", full, less), ("b", less, full), (None, full[:20], less[:20])), (("c", full, full),)]
    for group in docs:
        known = _rounds(spark)
        left, right = (_pages(spark, {d[0]: d[side] for d in group}) for side in (1, 2))
        got = {r["doc"]: r["distance"] for r in edit_distance.joined_text_scores(left, right, "doc", "seq", "text", block=16).collect()}
        assert got == {d: _plain(" ".join(a), " ".join(b)) for d, a, b in group}
        assert _rounds(spark) == known
    # pages that one side does not have at all, the last one among them
    rows = [r for r in _pages(spark, {"d": full}).collect()]
    some = [r for k, r in enumerate(rows) if k % 3 and k < 22]
    known = _rounds(spark)
    got = edit_distance.joined_text_scores(*(spark.createDataFrame(x, "doc string, seq int, text string") for x in (rows, some)),
                                           "doc", "seq", "text", block=16).collect()
    assert [r["distance"] for r in got] == [_plain(*(" ".join(r["text"] for r in x) for x in (rows, some)))]
    assert _rounds(spark) == known


def test_distance_is_not_the_pages_sum(spark):
    """Other signs, pages numbered otherwise, numbers of another type or pages over a block: the text is compared as a whole."""
    rnd = random.Random(17)
    full = ["".join(rnd.choices("abcdef ", k=rnd.randint(4, 10))) for _ in range(12)]
    other = [t.replace("a", "x") if k % 5 == 0 else t for k, t in enumerate(full)]
    left = {"signs": full, "moved": full, "long": ["".join(full[:6]), *full[6:]], "equal": full}
    right = {"signs": other, "moved": ["new", *full[1:], "page"][1:], "long": ["".join(other[:6]), *full[6:]], "equal": full}
    want = {d: _plain(" ".join(left[d]), " ".join(right[d])) for d in left}
    known = _rounds(spark)
    pages = _pages(spark, left), _pages(spark, right)
    for a, b in (pages, (pages[0], pages[1].withColumn("seq", F.format_string("%03d", "seq")))):
        got = {r["doc"]: r["distance"] for r in edit_distance.joined_text_scores(a, b, "doc", "seq", "text", block=16).collect()}
        assert got == want
    assert len(_rounds(spark) - known) >= 2


def test_page_bound(monkeypatch):
    rnd = random.Random(19)
    for _ in range(200):
        a, b = ("".join(rnd.choices("abé😀", k=rnd.randint(1, 30))) for _ in range(2))
        assert edit_distance.whole_distance(a, b) == _plain(a, b)
        assert edit_distance.page_bound(a, b) == _plain(a, b)
        near = "".join(rnd.choice(("", c, c, c, c, c + "b")) for c in a * 4)
        assert edit_distance.near_distance(a * 4, near) in (None, _plain(a * 4, near))
        assert edit_distance.near_distance(a * 9, (a * 9)[1:]) == edit_distance.near_distance((a * 9)[1:], a * 9) == 1
    assert edit_distance.page_bound("", "ab") == edit_distance.page_bound("ab", "") == 2
    monkeypatch.setattr(edit_distance, "WHOLE", 6)
    monkeypatch.setattr(edit_distance, "STRETCH", 4)
    for _ in range(100):
        a = "".join(rnd.choices("abcdefghijklmnopqrst", k=rnd.randint(40, 120)))
        near, far = a[:20] + a[30:], "".join(rnd.choices("ab", k=rnd.randint(1, 120)))
        for b in (near, far, a[::-1], a[:1] * 50):
            assert _plain(a, b) <= edit_distance.page_bound(a, b) <= len(a) + len(b)


def test_pages_of_one_number_have_no_bound(spark):
    rows = [("d", 1, "ab"), ("d", 2, "cd"), ("d", 2, "e"), ("e", 1, "ab"), ("e", None, "x"), ("f", 1, "abc"), ("f", 2, None)]
    less = [("d", 1, "b"), ("d", 2, "cd"), ("e", 1, "ab"), ("e", None, "y"), ("f", 2, "d"), ("g", 1, None)]
    sides = [spark.createDataFrame(x, "doc string, seq int, text string") for x in (rows, less)]
    got = {r["__doc"]: (r["left_chars"], r["right_chars"], r["bound"], r["times"]) for r in edit_distance._documents(*sides, "doc", "seq", "text", " ", 16).collect()}
    assert got.pop("d")[3] == 2
    assert got == {"e": (4, 4, 1, 1), "f": (4, 1, 5, 1), "g": (0, 0, 1, 1)}
