"""D1-D5 and the skew-safe running sums, against brute force."""

import random
import struct
import zlib

from pyspark.sql import functions as F

from labelqa.operators import layout, prefix


def manifest(spark, skew=True):
    random.seed(7)
    rows = []
    for d in range(4):
        n = 300 if (skew and d == 0) else random.randint(1, 9)   # doc 0 is hot
        seqs = random.sample(range(1, 5000), n)
        rows += [(f"doc{d}", s, random.randint(10, 900), random.randint(10, 900)) for s in seqs]
    return rows, spark.createDataFrame(rows, "doc string, seq long, width long, height long")


def test_composite_layout_brute_force(spark):
    rows, df = manifest(spark)
    got = {(r.doc, r.seq): r for r in layout.composite_layout(df, chunk=16).collect()}
    for d in {r[0] for r in rows}:
        items = sorted(r for r in rows if r[0] == d)
        y = 0
        for _, s, w, h in items:
            g = got[(d, s)]
            assert (g.x, g.y) == (0, y)
            assert g.canvas_width == max(i[2] for i in items)
            assert g.canvas_height == sum(i[3] for i in items)
            y += h


def test_page_layout_brute_force(spark):
    rows, df = manifest(spark)
    got = {(r.doc, r.seq): r for r in layout.page_layout(df, chunk=8).collect()}
    for d in {r[0] for r in rows}:
        items = sorted(r for r in rows if r[0] == d)
        for k, (_, s, w, h) in enumerate(items, 1):
            g = got[(d, s)]
            assert g.page_no == k and g.n_pages == len(items)
            assert g.scale_x == 612.0 / w and g.scale_y == 792.0 / h


def test_document_format_dispatch(spark):
    _, df = manifest(spark, skew=False)
    assert "page_no" in layout.document(df, "pdf").columns
    assert "canvas_width" in layout.document(df, "png").columns
    try:
        layout.document(df, "tiff")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_page_spans_match_joined_text(spark):
    pages = [("a", 1, "first page"), ("a", 2, ""), ("a", 3, "éclat"), ("b", 5, "x")]
    df = spark.createDataFrame(pages, "doc string, seq long, text string")
    spans = {(r.doc, r.seq): r for r in layout.page_spans(df, "doc", "seq", "text", chunk=2).collect()}
    joined = {r.doc: r.text for r in layout.join_page_texts(df, "doc", "seq", "text").collect()}
    assert joined["a"] == "first page  éclat"   # D5: pages joined with one space
    for d, s, t in pages:
        sp = spans[(d, s)]
        assert joined[d][sp.start_pos:sp.end_pos] == t
        assert sp.total_len == len(joined[d])


def test_rank_within_hot_group(spark):
    rows = [("hot", f"p{i:05d}") for i in range(500)] + [("cold", "b"), ("cold", "a")]
    df = spark.createDataFrame(rows, "g string, path string")
    got = {(r.g, r.path): r.rank for r in prefix.rank_within(df, "g", "path", partitions=6).collect()}
    assert got[("cold", "a")] == 1 and got[("cold", "b")] == 2
    assert all(got[("hot", f"p{i:05d}")] == i + 1 for i in range(500))


def png_bytes(w, h):
    def chunk(t, data):
        return struct.pack(">I", len(data)) + t + data + struct.pack(">I", zlib.crc32(t + data))
    raw = b"".join(b"\x00" + b"\x00\x00\x00" * w for _ in range(h))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_admit_images(spark):
    files = spark.createDataFrame([("a.png", bytearray(png_bytes(3, 2))), ("b.png", bytearray(b"nope")),
                                   ("c.jpg", bytearray(b""))], "path string, content binary")
    got = {r.path: r for r in layout.admit_images(files).collect()}
    assert (got["a.png"].width, got["a.png"].height, got["a.png"].admitted) == (3, 2, True)
    assert got["b.png"].admitted is False and got["b.png"].error == "Invalid image data"
    assert got["c.jpg"].admitted is False


def test_admit_images_decoded(spark, tmp_dir):
    import os
    os.makedirs(os.path.join(tmp_dir, "label_001"))
    with open(os.path.join(tmp_dir, "label_001", "a.png"), "wb") as fh:
        fh.write(png_bytes(3, 2))
    with open(os.path.join(tmp_dir, "label_001", "b.jpg"), "wb") as fh:
        fh.write(b"not an image")
    got = {os.path.basename(r.path): r for r in layout.admit_images_decoded(spark, tmp_dir).collect()}
    assert (got["a.png"].width, got["a.png"].height, got["a.png"].admitted) == (3, 2, True)
    assert got["b.jpg"].admitted is False and got["b.jpg"].error == "Invalid image data"


def test_running_sums_struct_order_hot_group(spark):
    random.seed(11)
    rows = [("hot" if i % 10 else "cold", random.randint(0, 50), i % 7, random.randint(1, 9))
            for i in range(700)]
    df = spark.createDataFrame(rows, "doc string, a long, b long, h long").select(
        "doc", F.struct("a", "b", F.monotonically_increasing_id().alias("u")).alias("seq"), "h")
    got = prefix.running_sums(df, "doc", "seq", ["h"], totals={"total": ("sum", "h")}).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc, []).append(r)
    for d, rs in by_doc.items():
        rs.sort(key=lambda r: (r.seq.a, r.seq.b, r.seq.u))
        acc = 0
        for r in rs:
            assert r.h_before == acc and r.total == sum(x.h for x in rs)
            acc += r.h
