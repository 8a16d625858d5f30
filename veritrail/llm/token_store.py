"""Token ids as binary shards: one zstandard frame a document, one dictionary shared by all.

The dictionary is trained on the serialized id arrays of a bounded sample. A shard is one binary value:

    magic "VTOK1", width of an id in bytes (u8), SHA-256 of the dictionary, number of documents n (u32)
    n document ids (i64), n null flags (u8), n + 1 offsets of frames (u64), the frames

so that one document is read by its offset, without its neighbours. Shards are rows of a Parquet table that
Spark writes with its commit protocol (a task that runs twice leaves one copy, on any file system),
in ascending document id: range partitions by id, sorted within.

Edge cases: a null text is encoded as an empty one: the end id alone. A null id sorts first. Rows
with the same id stand side by side, in any order. An empty table writes no shard and reads as no rows.
Strings of special tokens in a text become these tokens, as in the library's plain call. Further columns of documents are ignored. Texts of any length are
encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.llm.common import batches_of, new_path, process_store, settle

MAGIC = b"VTOK1"
HEAD = "<5sB32sI"
END_ID = 0
#: Bounds of the dictionary's sample: documents (smallest id hashes), characters of each (from anywhere in it), size of the result.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 256, 65_536, 65_536
SHARD_BYTES = 4 << 20  #: a shard is closed after the document that passes this
LEVEL = 1
BATCH_ROWS, BATCH_SHARDS = 512, 16  #: handed to Python at a time
MAX_PIECES = 600_000  #: cached encodings a worker, before those of the next batch; the newer half goes beyond that

SHARDS = "part int, seq int, n_docs int, part_start long, n_tokens long, dict_hash string, shard binary"
DECODED = "doc_id long, part_start long, n_tokens long, ids_crc32 long"


class PieceEncoder:
    """A tokenizer with a cache of space-led pieces.

    The byte-level pre-tokenizer takes a space only as the first character of a piece, so a text whose
    spaces all stand singly between visible characters can be cut before each of them, and the pieces' ids joined
    are the text's. Any other text is encoded as it is. New
    pieces are encoded together, as one text, and its ids cut where a token starts with a space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's other cores have tasks of their own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "HI"[self.width // 4]
        vocab = self.tokenizer.get_vocab()
        self.led = np.zeros(max(vocab.values(), default=0) + 1, bool)  # by id: the token starts with a space, so where it is a word begins
        self.led[[k for t, k in vocab.items() if t[0] in " \u0120"]] = True  # U+0120 is a byte-level space
        self.pieces: dict[str, bytes | None] = {}

    @classmethod
    def of_process(cls, path: str) -> PieceEncoder:
        """The one of this worker process, kept from task to task."""
        store = process_store()
        key = f"tokenizer {path}"
        if key not in store:
            store[key] = cls(path)
        return store[key]

    def raw(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space at their ends or spaces, each with a space before it, from one text of all."""
        raw = self.raw([f" {' '.join(words)}"])[0]
        cuts = (np.flatnonzero(self.led[np.frombuffer(raw, f"u{self.width}")]) * self.width).tolist()
        if len(cuts) != len(words) or cuts[:1] != [0]:  # a special token took a space
            return self.raw([f" {w}" for w in words])
        return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)]

    def learn(self, new: list[str]) -> None:
        """Cache new pieces; None marks one that touches white space, so that its text can't be cut."""
        whole = [p for p in new if p and p.strip() == p]
        self.pieces.update(zip(whole, self.words(whole), strict=True))
        if len(whole) < len(new):
            self.pieces.update(dict.fromkeys(p for p in new if not p or p.strip() != p))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") for t in texts]
        if len(self.pieces) > MAX_PIECES:  # the oldest half has the frequent words
            self.pieces = dict(islice(self.pieces.items(), MAX_PIECES // 2))
        known = self.pieces
        self.learn(list(set().union(*(c[1:] for c in cut)).difference(known)))
        first = self.raw([c[0] for c in cut])
        out: list[bytes] = []
        for text, head, c in zip(texts, first, cut, strict=True):
            if len(c) == 1:
                out.append(head)
                continue
            found = None if c[0][-1:].isspace() else [head, *map(known.__getitem__, c[1:])]
            out.append(self.raw([text])[0] if found is None or None in found else b"".join(found))
        return out


def dictionary(samples: list[bytes]) -> bytes:
    """Trained on serialized id arrays; the samples themselves where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICT_BYTES]


def loaded(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def pack(doc_ids: list[int | None], frames: list[bytes], width: int, dict_hash: bytes) -> bytes:
    n = len(doc_ids)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    offsets = np.zeros(n + 1, "<u8")
    offsets[1:] = np.cumsum([len(f) for f in frames])
    return b"".join([struct.pack(HEAD, MAGIC, width, dict_hash, n), ids.tobytes(), nulls.tobytes(), offsets.tobytes(), *frames])


class Shard:
    """Reads a shard; any document by its place alone."""

    def __init__(self, data: bytes, dict_data: bytes):
        magic, self.width, dict_hash, self.n = struct.unpack_from(HEAD, data)
        if magic != MAGIC or dict_hash != hashlib.sha256(dict_data).digest():
            raise ValueError("not a shard, or written with another dictionary")
        at = struct.calcsize(HEAD)
        self.doc_ids = np.frombuffer(data, "<i8", self.n, at)
        self.nulls = np.frombuffer(data, np.uint8, self.n, at + 8 * self.n)
        self.offsets = np.frombuffer(data, "<u8", self.n + 1, at + 9 * self.n)
        self.frames = memoryview(data)[at + 9 * self.n + 8 * (self.n + 1) :]
        self.reader = zstandard.ZstdDecompressor(dict_data=loaded(dict_data))

    def doc_id(self, i: int) -> int | None:
        return None if self.nulls[i] else int(self.doc_ids[i])

    def ids(self, i: int) -> np.ndarray:
        raw = self.reader.decompress(self.frames[int(self.offsets[i]) : int(self.offsets[i + 1])])
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    """Encode all texts into a token store; returns its folder, with tables "dictionary" and "shards"."""
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()  # ids alone are ordered
    beyond = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    piece = F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit(1)), beyond + 1).cast("int") + 1, F.lit(SAMPLE_CHARS))
    found = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", piece.alias("text"))
    found = found.limit(SAMPLE_DOCS).collect()  # SAMPLE_DOCS x SAMPLE_CHARS at most
    sample = [r.text for r in sorted(found, key=lambda r: (r.doc_id, r.text))]
    data = dictionary(PieceEncoder(tokenizer_path).encode(sample)) if sample else b""
    hashed = hashlib.sha256(data).digest()
    spark.createDataFrame([(bytearray(data), hashed.hex())], "data binary, dict_hash string").write.parquet(f"{path}/dictionary")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = PieceEncoder.of_process(tokenizer_path)
        end = array(encoder.kind, [END_ID]).tobytes()
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded(data)).compress
        seq, start, tokens, size = 0, 0, 0, 0
        doc_ids: list[int | None] = []
        frames: list[bytes] = []

        def close() -> pa.RecordBatch:
            values = [part, seq, len(doc_ids), start, tokens, hashed.hex(), pack(doc_ids, frames, encoder.width, hashed)]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[c.split()[0] for c in SHARDS.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                doc_ids.append(doc_id)
                frames.append(squeeze(ids + end))
                tokens += len(ids) // encoder.width + 1
                size += len(frames[-1])
                if size >= SHARD_BYTES:
                    yield close()
                    seq, start, tokens, size, doc_ids, frames = seq + 1, start + tokens, 0, 0, [], []
        if doc_ids:
            yield close()

    with batches_of(spark, BATCH_ROWS):
        rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(write, SHARDS).write.parquet(f"{path}/shards")
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the store's shards."""
    data = bytes(spark.read.parquet(f"{path}/dictionary").collect()[0].data)  # one row of DICT_BYTES at most
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(blob, data)
                ids = [shard.ids(i) for i in range(shard.n)]
                counts = np.array([len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.doc_id(i) for i in range(shard.n)], pa.int64()),
                        pa.array(start + np.cumsum(counts) - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    ],
                    names=["doc_id", "part_start", "n_tokens", "ids_crc32"],
                )

    from pyspark.sql import Window

    # one row for each partition that wrote shards, so few enough for one window and a broadcast
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    placed = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("part_start")).alias("start"), "shard")
    with batches_of(spark, BATCH_SHARDS):
        return settle(placed.mapInArrow(read, DECODED).withColumnRenamed("part_start", "start"), "decoded")
