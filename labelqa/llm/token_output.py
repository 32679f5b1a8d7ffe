"""Token ids in training order, as fixed-stride binary shards.

Every document is tokenised whole, ended by the end-of-text id and cut into
sequences of ``seq_len`` ids. A sequence has a number (document, piece); a
keyed Feistel network with cycle walking permutes the numbers, and the
permuted numbers in rising order are the global slots. Equal ranges of the
permuted numbers are the shards, so one shuffle brings each shard to one task,
which sorts and writes it. A record has a fixed stride (16 bytes of header,
``2 * seq_len`` of ids, a two-byte zero as the line separator of Spark's text
sink, whose commit protocol makes lost tasks harmless); a reader finds slot s
at ``(s - first slot of the shard) * stride`` and can resume anywhere.

The domain of the network is an upper bound (ids are no more than bytes), so
nothing has to be counted, numbered or tokenised beforehand.

Defined cases: null or empty text is one sequence with the end-of-text id
only; a null ``doc_id`` is flagged in the header and read back as null;
repeated rows make repeated records, ordered by their bytes; an empty table
makes no shard; extra columns are not read. Ids sparse beyond 62 bits are
hashed into the domain; numbers that coincide only share their place.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_uri, part_files, shared_path, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed: the vocabulary was built with it
SEQ_LEN, KEY, ROUNDS, END = 512, 0x5EED_0F_0DE5, 6, "\x00\x00"
SHARD_TEXT_BYTES, MOST_SHARDS = 64 << 20, 20_000

#: White space of the pattern; runs from LONG_RUN on are cut out before it, since
#: its backtracking over a run of about half a million overflows the stack.
LONG_RUN, SPACES = 10_000, "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_ENCODERS: dict = {}


def encoder(ranks_file: bytes):
    """One tokenizer per worker process."""
    key = hash(ranks_file)
    if key not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        _ENCODERS[key] = (tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), len(ranks))
    return _ENCODERS[key]


def token_ids(encode, text: str, long_run: int = LONG_RUN) -> list[int]:
    """The ids of the whole text. A run of white space is one match of the
    pattern but for its last character, which belongs to what follows."""
    out, at = [], 0
    for run in re.finditer(f"[{SPACES}]{{{long_run},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encode.encode_ordinary(text[at:run.start()])
        out += encode._encode_single_piece(text[run.start():end])
        at = end
    return out + encode.encode_ordinary(text[at:])


class Feistel:
    """A keyed permutation of range(size); values outside walk on until inside."""

    def __init__(self, size: int, key: int, rounds: int = ROUNDS):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.uint64((key * (2 * r + 1) + r * 0x9E3779B97F4A7C15) & (2**64 - 1)) for r in range(1, rounds + 1)]

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys:
            y = (right + k) * np.uint64(0xD6E8FEB86659FD93)
            y = (y ^ (y >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((y ^ (y >> np.uint64(29))) & self.mask)
        return (left << np.uint64(self.half)) | right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        y = self._once(x.astype(np.uint64))
        while (out := y >= np.uint64(self.size)).any():
            y[out] = self._once(y[out])
        return y


def record_type(seq_len: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n", "<u2"), ("no_id", "<u2"), ("ids", "<u2", (seq_len,))])


def write_shards(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, key: int = KEY, vocabulary: str = VOCABULARY,
                 shard_text_bytes: int = SHARD_TEXT_BYTES) -> int:
    """Writes ``path/shard=<n>/`` and returns the number of shards."""
    if not 1 <= seq_len <= 65535:
        raise ValueError("seq_len must be 1 to 65535")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = F.octet_length("text")
    seen = rows.agg(F.sum(size).alias("all"), F.max(size).alias("longest"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    pieces = (seen["longest"] or 0) // seq_len + 1
    lo = seen["lo"] or 0
    numbers = min((seen["hi"] or 0) - lo + 1, (1 << 62) // pieces)
    sparse = numbers < (seen["hi"] or 0) - lo + 1
    shards = min(MOST_SHARDS, max(1, -(-(seen["all"] or 0) // shard_text_bytes)))
    domain = numbers * pieces
    shuffled = Feistel(domain, key)
    width = -(-domain // shards)
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())      # a vocabulary file, about a megabyte
    record = record_type(seq_len)

    def cut(batches):
        encode, end = encoder(ranks.value)
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                piece = batch.slice(part, 512)
                ids, texts, hashes = (piece.column(k).to_pylist() for k in range(3))
                blocks = []
                for doc, text, mark in zip(ids, texts, hashes, strict=True):
                    tokens = np.array([*token_ids(encode, text), end], "<u2")
                    n = -(-len(tokens) // seq_len)
                    out = np.zeros(n, record)
                    flat = np.full(n * seq_len, end, "<u2")
                    flat[:len(tokens)] = tokens
                    out["ids"] = flat.reshape(n, seq_len)
                    out["doc_id"], out["no_id"], out["piece"] = doc or 0, doc is None, np.arange(n)
                    out["n"] = seq_len
                    out["n"][-1] = len(tokens) - (n - 1) * seq_len
                    place = (doc - lo) if doc is not None and not sparse else mark % numbers
                    blocks.append((out, place * pieces + np.arange(n, dtype=np.uint64)))
                if not blocks:
                    continue
                out = np.concatenate([b[0] for b in blocks])
                slots = shuffled(np.concatenate([b[1] for b in blocks]))
                offsets = np.arange(len(out) + 1, dtype=np.int64) * record.itemsize
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(out), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array((slots // np.uint64(width)).astype(np.int32)), pa.array(slots.astype(np.int64)), binary.cast(pa.binary())], ["shard", "slot", "record"])

    cutting = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark")).mapInArrow(cut, "shard int, slot long, record binary")
    placed = cutting.repartitionById(shards, "shard").sortWithinPartitions("shard", "slot", "record")
    (placed.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", END).text(path))
    return shards


def shard_index(spark, path: str, seq_len: int = SEQ_LEN) -> DataFrame:
    """``shard, file, n, first_slot``: one row per shard, from file sizes alone."""
    from pyspark.sql import Window

    stride = record_type(seq_len).itemsize + len(END)
    files = part_files(spark, path, "shard")
    files = files.select("shard", F.col("path").alias("file"), (F.col("length") / stride).cast("long").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("first_slot", before)


def read_sequences(spark, path: str, seq_len: int = SEQ_LEN, chunk_bytes: int = 8 << 20, first: int = 0) -> DataFrame:
    """``slot, shard, byte_offset, doc_id, piece, n_tokens, tokens`` from slot
    ``first`` on, by sequential reads of whole strides."""
    record = record_type(seq_len)
    stride = record.itemsize + len(END)
    held = np.dtype([("record", record), ("end", "<u2")])
    chunk = max(1, chunk_bytes // stride)
    index = shard_index(spark, path, seq_len).where(F.col("first_slot") + F.col("n") > first)
    index = index.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(chunk).cast("long"))))
    index = index.repartition(max(1, index.count() // 2), "file", "at")     # a few chunks a task

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = min(chunk, row["n"] - row["at"])
                with open_uri(row["file"]) as f:
                    raw = f.read_at(n * stride, row["at"] * stride)
                got = np.frombuffer(raw, held)["record"]
                slots = row["first_slot"] + row["at"] + np.arange(n)
                got, at, slots = got[slots >= first], (row["at"] + np.arange(n))[slots >= first], slots[slots >= first]
                ids = [r["ids"][:r["n"]].tobytes() for r in got]
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots), pa.array(np.full(len(got), row["shard"], np.int32)), pa.array(at * stride),
                    pa.array(got["doc_id"], mask=got["no_id"] != 0), pa.array(got["piece"].astype(np.int32)), pa.array(got["n"].astype(np.int32)), pa.array(ids, pa.binary())],
                    ["slot", "shard", "byte_offset", "doc_id", "piece", "n_tokens", "tokens"])

    return index.select("shard", "file", "n", "first_slot", "at").mapInArrow(read, "slot long, shard int, byte_offset long, doc_id long, piece int, n_tokens int, tokens binary")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Writes the shards and reads them back: one row per sequence."""
    spark = docs.sparkSession
    path = shared_path(spark, "shards")
    write_shards(docs, path, **options)
    seq_len = options.get("seq_len", SEQ_LEN)
    return read_sequences(spark, path, seq_len).select("slot", "shard", "byte_offset", "doc_id", "piece", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))
