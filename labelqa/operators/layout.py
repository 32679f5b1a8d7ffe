"""Document layout over an image manifest ``(doc, seq, width, height)``.

Pixels are never moved: a document is described by where each image goes.

* D2 composite: one tall canvas, width = widest image, height = sum of
  heights, image k at ``y = sum of earlier heights``, ``x = 0``.
* D3 pages: one letter-size page per image in order, image stretched to the
  page (aspect ratio not kept).
* D5 page text: page texts of a document in order, joined by one space;
  represented by each page's character span so no document is gathered in
  one task; ``join_page_texts`` builds the text for bounded documents.

Offsets use the skew-safe running sums of ``prefix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import DEFAULT_CHUNK, running_sums

# Letter page size in points.
PAGE_WIDTH, PAGE_HEIGHT = 612.0, 792.0
FORMATS = ("pdf", "png")


def composite_layout(manifest: DataFrame, doc: str = "doc", seq: str = "seq",
                     chunk: int = DEFAULT_CHUNK) -> DataFrame:
    m = manifest.select(doc, seq, "width", "height")
    r = running_sums(m, doc, seq, ["height"], chunk,
                     totals={"canvas_width": ("max", "width"),
                             "canvas_height": ("sum", "height")})
    return r.select(doc, seq, "width", "height", F.lit(0).cast("long").alias("x"),
                    F.col("height_before").cast("long").alias("y"),
                    F.col("canvas_width").cast("long").alias("canvas_width"),
                    F.col("canvas_height").cast("long").alias("canvas_height"))


def page_layout(manifest: DataFrame, doc: str = "doc", seq: str = "seq",
                chunk: int = DEFAULT_CHUNK) -> DataFrame:
    m = manifest.select(doc, seq, "width", "height")
    r = running_sums(m, doc, seq, [], chunk, totals={"n_pages": ("count", "width")})
    return r.select(
        doc, seq, (F.col("rank_before") + 1).cast("long").alias("page_no"),
        F.col("n_pages").cast("long").alias("n_pages"),
        F.lit(PAGE_WIDTH).alias("page_width"), F.lit(PAGE_HEIGHT).alias("page_height"),
        (F.lit(PAGE_WIDTH) / F.col("width")).alias("scale_x"),
        (F.lit(PAGE_HEIGHT) / F.col("height")).alias("scale_y"))


def document(manifest: DataFrame, fmt: str = "pdf", **kw) -> DataFrame:
    """Validated format chooses the layout; unknown format is an error."""
    if fmt == "pdf":
        return page_layout(manifest, **kw)
    if fmt == "png":
        return composite_layout(manifest, **kw)
    raise ValueError("Unknown document format output.")


def empty_documents(docs: DataFrame, manifest: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents with no admitted image (an error in the reference)."""
    return docs.join(manifest.select(doc).distinct(), doc, "left_anti")


def page_spans(pages: DataFrame, doc: str, seq: str, text: str, sep: str = " ",
               chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``[start, end)`` of each page's text in the joined document text."""
    p = pages.select(doc, seq, F.coalesce(F.length(text), F.lit(0)).cast("long").alias("_len"))
    r = running_sums(p, doc, seq, ["_len"], chunk,
                     totals={"n_pages": ("count", "_len"), "_chars": ("sum", "_len")})
    start = F.col("_len_before") + F.col("rank_before") * len(sep)
    return r.select(
        doc, seq, (F.col("rank_before") + 1).alias("page_no"), start.alias("start_pos"),
        (start + F.col("_len")).alias("end_pos"), F.col("n_pages").cast("long").alias("n_pages"),
        (F.col("_chars") + (F.col("n_pages") - 1) * len(sep)).cast("long").alias("total_len"))


def join_page_texts(pages: DataFrame, doc: str, seq: str, text: str, sep: str = " ") -> DataFrame:
    """D5 text for documents of bounded size: ordered join within one row. A
    null page text counts as empty, as in ``page_spans``."""
    return pages.groupBy(doc).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, text))),
                                 lambda x: F.coalesce(x[text], F.lit(""))), sep).alias("text"))


# ------------------------------------------------------------------ D1

PNG_MAGIC = "89504E470D0A1A0A"


def admit_images(files: DataFrame) -> DataFrame:
    """D1 over a ``binaryFile`` scan: PNG size from the header bytes in SQL.

    Returns ``(path, width, height, admitted, error)``; non-PNG or truncated
    content is rejected with an error text instead of failing the job.
    """
    c = F.col("content")
    is_png = (F.hex(F.substring(c, 1, 8)) == PNG_MAGIC) & (F.length(c) >= 24)
    w = F.conv(F.hex(F.substring(c, 17, 4)), 16, 10).cast("long")
    h = F.conv(F.hex(F.substring(c, 21, 4)), 16, 10).cast("long")
    ok = is_png & (w > 0) & (h > 0)
    return files.select(
        "path", F.when(ok, w).alias("width"), F.when(ok, h).alias("height"),
        ok.alias("admitted"),
        F.when(~ok, F.lit("Invalid image data")).alias("error"))


def admit_images_decoded(spark, root: str) -> DataFrame:
    """D1 for any format ImageIO reads: Spark's ``image`` source decodes each
    file; undecodable ones come back with width -1 and are rejected.

    Returns ``(path, width, height, admitted, error)`` (path without scheme).
    """
    from ..sources.cases import IMAGE_RE, norm_path
    img = (spark.read.format("image").option("dropInvalid", False)
           .option("recursiveFileLookup", "true").load(root))
    img = img.filter(F.col("image.origin").rlike(IMAGE_RE))
    ok = F.col("image.width") > 0
    return img.select(
        norm_path(F.col("image.origin")).alias("path"),
        F.when(ok, F.col("image.width").cast("long")).alias("width"),
        F.when(ok, F.col("image.height").cast("long")).alias("height"),
        ok.alias("admitted"),
        F.when(~ok, F.lit("Invalid image data")).alias("error"))
