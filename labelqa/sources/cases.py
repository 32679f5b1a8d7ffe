"""Assessment cases on a file system.

A case is a directory ``label_*`` holding images (``.png``/``.jpg``, any
case) and one ``expected_output.json``. Discovery lists the case directories
with the ``case_listing`` source (names and lengths only, contents are never
read), groups by directory and numbers cases 1..n in directory order. A
directory without files is a case without images, and an image of zero bytes
counts as an image. Instead of a folder, any table of ``(path, length)`` (an
inventory of an object store) gives the same through ``listed_files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .listing import list_directories, qualified

# Fixed values of the case layout and its error texts.
CASE_DIR_PREFIX = "label_"
GOLDEN_NAME = "expected_output.json"
IMAGE_RE = r"(?i)\.(png|jpg)$"
NO_IMAGES = "No image files found"
NO_GOLDEN = "Expected output JSON not found"
NO_CASES = "No label directories found"


SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"


def norm_path(c):
    """Path text without scheme and its slashes (``file:/a`` = ``file:///a`` = ``/a``)."""
    return F.concat(F.lit("/"), F.regexp_replace(c, SCHEME_RE, ""))


def _norm_root(root: str) -> str:
    import re
    return "/" + re.sub(SCHEME_RE, "", root.rstrip("/")).lstrip("/")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, dir, name, length)`` of every file below ``root``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(root).select("path", "length"))
    return files.select(
        "path", "length",
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))


def listed_files(files: DataFrame, root: str) -> DataFrame:
    """Case files among ``files(path, length)``: those of directories
    ``label_*`` directly below ``root``. A path that ends in ``/`` marks a
    directory, which may hold no file."""
    dir_, name = F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.regexp_extract("path", r"([^/]*)$", 1)
    f = files.select("path", "length", dir_.alias("dir"), F.nullif(name, F.lit("")).alias("name"))
    parent = norm_path(F.regexp_extract("dir", r"^(.*)/[^/]+$", 1))
    f = f.select("*", F.regexp_extract("dir", r"([^/]+)$", 1).alias("case_dir"))
    return f.filter(F.col("case_dir").startswith(CASE_DIR_PREFIX) & (parent == _norm_root(root)))


def _case_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, dir, name, case_dir`` of the case files below ``root``."""
    found = list_directories(spark, root, CASE_DIR_PREFIX)
    if found is None:
        return listed_files(list_files(spark, root), root)
    dir_ = F.concat(F.lit(qualified(spark, root) + "/"), "case_dir")
    return found.select(F.concat(dir_, F.lit("/"), "name").alias("path"), "length", dir_.alias("dir"), "name", "case_dir")


def inventory_of(files: DataFrame) -> DataFrame:
    """S1/S1b of case files (see ``listed_files``): per case directory the
    image count, golden path and issues.

    Counts are partial aggregates; no list of files is gathered per case.
    """
    per = files.groupBy("dir", "case_dir").agg(
        F.count_if(F.coalesce(F.col("name").rlike(IMAGE_RE), F.lit(False))).alias("n_images"),
        F.max(F.when(F.col("name") == GOLDEN_NAME, F.col("path"))).alias("golden"))
    issues = F.filter(F.array(
        F.when(F.col("n_images") == 0, F.lit(NO_IMAGES)),
        F.when(F.col("golden").isNull(), F.lit(NO_GOLDEN))),
        lambda x: x.isNotNull())
    return per.select("dir", "case_dir", "n_images", "golden", issues.alias("issues"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """S1/S1b of a folder."""
    return inventory_of(_case_files(spark, root))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Images of every case, ``seq`` = 1-based rank of the path within the case."""
    from ..operators.prefix import rank_within
    img = _case_files(spark, root).filter(F.col("name").rlike(IMAGE_RE)).select(
        "dir", "case_dir", "path", "length")
    return rank_within(img, "dir", "path").withColumnRenamed("rank", "seq")


def number_cases(cases: DataFrame) -> DataFrame:
    """Case numbers 1..n in directory order.

    A distributed rank (range-partitioned sort + per-partition offsets), so
    even millions of cases never meet in one task.
    """
    from ..operators.prefix import rank_within
    g = cases.withColumn("__all", F.lit(0))
    return rank_within(g, "__all", "case_dir").withColumnRenamed("rank", "case_no").drop("__all")


def discover(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """Numbered complete cases; with ``strict`` any incomplete case raises.

    ``FileNotFoundError`` as in the reference: no case directory, a case
    without images, or without its golden file.
    """
    inv = inventory(spark, root)
    if strict:
        bad = (inv.filter(F.size("issues") > 0).orderBy("case_dir")
               .select("case_dir", "issues").limit(1).collect())
        if bad:
            raise FileNotFoundError(f"{bad[0]['issues'][0]} in {bad[0]['case_dir']}")
        if inv.limit(1).count() == 0:
            raise FileNotFoundError(f"{NO_CASES} in {root}")
    return number_cases(inv.filter(F.size("issues") == 0))


def golden_texts(spark: SparkSession, root: str) -> DataFrame:
    """``(dir, json)`` whole-file text of every golden file.

    ``binaryFile`` + UTF-8 decode gives exactly one row per file whatever
    columns a consumer prunes.
    """
    t = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", GOLDEN_NAME).load(root))
    return t.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
                    F.decode("content", "UTF-8").alias("json"))


def image_bytes(spark: SparkSession, root: str) -> DataFrame:
    """S3: image bytes (``path, content``) for layout and extraction; Spark's
    source gives no row for an empty file (``assess.run_images`` fills them in)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(root).filter(F.col("path").rlike(IMAGE_RE)).select("path", "content"))


def texts(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Whole-text files (stage outputs such as OCR markdown)."""
    t = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob).load(root))
    return t.select("path", F.decode("content", "UTF-8").alias("text"))


def compact_texts(spark: SparkSession, root: str, out: str, glob: str = GOLDEN_NAME,
                  files_per_partition: int = 10000) -> DataFrame:
    """Small-files fix: whole-text files below ``root`` written
    once as parquet ``(dir, name, text)``; later runs read the table instead
    of listing and opening every small file again."""
    t = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob).load(root))
    rows = t.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                    F.decode("content", "UTF-8").alias("text"))
    rows.write.mode("overwrite").option("maxRecordsPerFile", files_per_partition).parquet(out)
    return spark.read.parquet(out)
