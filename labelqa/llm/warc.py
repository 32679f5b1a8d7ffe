"""WARC archives: index first, then ranged reads.

Writing: records of equal payload are met by their digest (a partial
aggregate, so a payload that a third of all pages share is no hot spot); the
latest keeps the payload, the others become revisit records. Each archive is
written by one task with Spark's text sink, whose line separator is the
record separator of the format, so lost tasks leave no half archives. The
index (archive, offset, length, URL, digest) is a table of its own, worked
out from the same lengths.

Reading: the wanted index rows are dealt out by archive in order of offset;
neighbouring byte ranges are read together and cut into records.

Defined cases: null html is the empty payload; null page ids and URLs are
written without their header and read back as null; rows with equal id and
payload that hold the response id are all responses; payloads under
``LEAST_BYTES`` are always responses; an empty table writes no archive; extra
columns are not read. Payloads are whole, whatever their length.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import open_uri, packed, part_files, shared_path, store, unpacked

LEAST_BYTES, ARCHIVE_BYTES = 1000, 32 << 20
SEPARATOR, HTTP = "\r\n\r\n", "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classified(pages: DataFrame) -> DataFrame:
    """``page_id, url, digest, n, type, refers_to``: no payload is shuffled."""
    rows = pages.select("page_id", _url().alias("url"), F.sha1(_payload()).alias("digest"), F.octet_length(_payload()).cast("long").alias("n"))
    keeper = (rows.where((F.col("n") >= LEAST_BYTES) & F.col("page_id").isNotNull()).groupBy("digest", "n")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    rows = rows.join(keeper, ["digest", "n"], "left")
    refers_to = F.when(F.col("page_id") < F.col("keeper"), F.col("keeper"))
    return rows.select("page_id", "url", "digest", "n", refers_to.alias("refers_to")).withColumn("type", _type())


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _url():
    return F.translate(F.col("url"), "\r\n", "")


def _type():
    return F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")


def _line(name: str, value):
    """A header line, left out where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def head():
    """The headers of a record, from the columns of ``classified``."""
    body = F.when(F.col("type") == "response", F.col("n")).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("type")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))), _line("WARC-Target-URI", F.col("url")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("type") == "revisit", F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Payload-Length: "), F.col("n").cast("string"), F.lit("\r\n"))).otherwise(""),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), (body + len(HTTP)).cast("string"), F.lit("\r\n\r\n"))


ORDER = ("archive", "page_id", "digest", "url")


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``path/archive=<n>/`` and returns the stored index:
    ``archive, offset, length, page_id, url, digest`` and what each record is. The payloads are
    shuffled once, as zstd, to the task of their archive; what each record is
    meets them there, by a window over the shuffle's own order."""
    size = pages.agg(F.sum(F.octet_length("html")).alias("n")).first()["n"] or 0
    archives = max(1, -(-size // archive_bytes))
    archive = F.pmod(F.xxhash64("page_id", "digest"), F.lit(archives)).cast("int").alias("archive")
    # the index comes first: lengths follow from the small columns; equal rows in
    # the order of an archive have equal lengths, so ties change nothing
    length = F.octet_length(head()) + len(HTTP) + F.when(F.col("type") == "response", F.col("n")).otherwise(0) + len(SEPARATOR)
    w = Window.partitionBy("archive").orderBy(*ORDER[1:]).rowsBetween(Window.unboundedPreceding, -1)
    index = classified(pages).select("*", archive).withColumn("length", length.cast("long"))
    index = store(index.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0))), "warc-index")
    # pages share much of their markup: a little of some of them helps to pack all
    shared = b"".join(bytes(r[0]) for r in pages.where("html is not null").select(F.substring(_payload(), 1, 2048)).limit(32).collect())
    body = _payload()
    carried = pages.select("page_id", _url().alias("url"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("n"), packed(body, 5, shared).alias("data"))
    carried = carried.select("page_id", "url", "digest", "n", "data", F.lit(None).cast("long").alias("refers_to"), archive)
    revisits = index.where("type = 'revisit'").select("page_id", F.lit(None).cast("string").alias("url"), "digest", "n", F.lit(None).cast("binary").alias("data"), "refers_to", "archive")
    met = carried.union(revisits).repartitionById(archives, "archive").sortWithinPartitions(*ORDER)
    told = Window.partitionBy("archive", "page_id", "digest")
    met = met.withColumn("refers_to", F.max("refers_to").over(told)).where("data is not null").withColumn("type", _type())
    text = F.concat(head(), F.lit(HTTP), F.coalesce(unpacked(F.when(F.col("type") == "response", F.col("data")), shared), F.lit("")))
    rows = met.select(*ORDER, text.alias("value")).sortWithinPartitions(*ORDER)
    rows.select("archive", "value").write.partitionBy("archive").option("lineSep", SEPARATOR).text(path)
    return index


def parse(raw: bytes) -> dict:
    """One record: its headers (names in lower case) and its payload."""
    head, _, block = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    fields = {k.lower(): v for k, v in fields.items()}
    size = int(fields["content-length"])
    if not version.startswith("WARC/") or len(block) != size + len(SEPARATOR) or not raw.endswith(SEPARATOR.encode()):
        raise ValueError("the index and the archive do not agree")
    return fields | {"payload": block[:size].partition(b"\r\n\r\n")[2]}


def ranges(rows: list[dict], gap: int, most: int):
    """Rows in order of offset, grouped into reads that skip at most ``gap``
    bytes and cover at most ``most`` (more only for a single record)."""
    held: list[dict] = []
    for row in rows:
        if held and (row["offset"] > held[-1]["offset"] + held[-1]["length"] + gap or row["offset"] + row["length"] - held[0]["offset"] > most):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(index: DataFrame, path: str, gap: int = 64 << 10, most: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, read by sorted, coalesced ranges. The
    digest of a response is taken from the bytes read and held against its header."""
    spark = index.sparkSession
    files = part_files(spark, path, "archive").select("archive", F.col("path").alias("file"))
    wanted = index.select("archive", "offset", "length").join(files, "archive")
    # long archives are read by several tasks; index rows are small, their reads are not
    parts = index.agg((F.coalesce(F.sum("length"), F.lit(0)) / (4 * most)).cast("int").alias("n")).first()["n"] + 1
    wanted = wanted.withColumn("part", F.floor(F.col("offset") / (4 * most))).repartition(parts, "archive", "part").sortWithinPartitions("archive", "offset").drop("part")
    names = [f.split()[0] for f in RECORD.split(", ")]

    def number(urn):
        return int(urn[len("<urn:page:"):-1]) if urn else None

    def read(batches):
        at, f = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for k, row in enumerate(rows):
                row["start"] = not k or rows[k - 1]["file"] != row["file"]
            cuts = [k for k, row in enumerate(rows) if row["start"]] + [len(rows)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if rows[a]["file"] != at:
                    at, f = rows[a]["file"], open_uri(rows[a]["file"])
                for group in ranges(rows[a:b], gap, most):
                    base = group[0]["offset"]
                    raw = f.read_at(group[-1]["offset"] + group[-1]["length"] - base, base)
                    out = []
                    for row in group:
                        rec = parse(raw[row["offset"] - base:row["offset"] - base + row["length"]])
                        digest, n = rec["warc-payload-digest"].removeprefix("sha1:"), int(rec.get("warc-payload-length", len(rec["payload"])))
                        if rec["warc-type"] == "response" and hashlib.sha1(rec["payload"]).hexdigest() != digest:
                            raise ValueError("a payload does not fit its digest")
                        out.append((number(rec.get("warc-record-id")), rec.get("warc-target-uri"), n, digest, rec["warc-type"], number(rec.get("warc-refers-to")), rec["payload"] if payloads else None))
                    columns = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return wanted.mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archives every page and reads all records back."""
    path = shared_path(pages.sparkSession, "warc")
    index = write_archives(pages, path, **options)
    return read_records(index, path, payloads=False).drop("payload")
