"""Removal of byte strings of LENGTH that occur more than once in a corpus, by suffix arrays.

1. Every text is cut into runs of windows by content-defined anchors (anchors.py); equal windows have equal anchor keys.
   Keys are counted; those seen twice or more go into a Bloom filter of bounded size.
2. Documents with no such key are finished. The others are written with their runs.
3. Runs of equal key and content are counted as one. Of each content one copy is fetched, of those that occur twice a second
   one from another place, and the suffix array of all copies of a key's contents that are
   in a task, by two-stage sorting, gives the windows that neighbours in its order share.
4. The windows found go back to the documents, by key and content, and become byte ranges.

Rows are told apart by a number that is written with them, so each of many copies of a row is a row of its own and at most two
of them are fetched.

A key with more contents to fetch than HOT is known from the counts and dealt anew as it is fetched: its windows are halved by where the anchor lies in them, and each
half's key is a hash of all bytes that its windows share, which are more than before. At the end
that is the window itself. Contents and keys are compared by 64-bit hashes, of two kinds; suffixes byte by byte.

Edge cases: a null or empty text has no bytes and nothing is removed. Texts shorter than LENGTH keep all.
Rows repeated in full are copies of each other: all lose their long repeats. Overlaps count, also in one document.
Strings are judged on the input. An empty table gives an empty table. Further columns are ignored by repeats_report()
and kept by drop_repeats(), which drops a character that is only partly removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from veritrail.llm.anchors import GRAM, LENGTH, Roller, runs
from veritrail.llm.common import settle, small_batches
from veritrail.llm.suffix_array import repeated

HOT = 8192  #: contents of a key that one task sorts at most
SORT_BYTES = 2 << 20  #: contents sorted together, besides the rest of a key
BLOOM_MOST = 1 << 28  #: bits (32 MB), however many keys; overfull, it only lets more through
BLOOM_PARTS = 64
BLOOM_RATE = 24  #: bits a key; so few others pass that most documents without repeats are finished early
BLOOM_SHIFTS = (6, 25, 44)

RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
RUNS = StructField("runs", ArrayType(StructType([StructField(n, t()) for n, t in (("start", IntegerType), ("n", IntegerType), ("key", LongType), ("place", IntegerType), ("print", LongType))])))


def to_utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def identified(docs: DataFrame, *kept: str) -> DataFrame:
    """(text, rest): rest is a struct of the columns kept, doc_id at least."""
    rest = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    return docs.select("text", rest.alias("rest"))


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(key): anchor keys of two runs or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            found = runs([to_utf8(t) for t in batch.column(0).to_pylist()], roller)
            keys, n = np.unique(found["key"].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.minimum(n, 2).astype(np.int32))], names=["key", "n"])

    counted = rows.select("text").mapInArrow(run, "key long, n int").groupBy("key").agg(F.sum("n").alias("n"))
    return settle(counted.filter("n > 1").select("key"), "repeat-keys")


def bloom(keys: DataFrame) -> np.ndarray:
    """Bits over the keys, three for each: BLOOM_PARTS rows reach the driver, 32 MB at most in all."""
    want = max(1 << 16, min(BLOOM_MOST, keys.count() * BLOOM_RATE))
    bits = 1 << (want - 1).bit_length()
    part_bits = bits // BLOOM_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for p in bloom_places(batch.column(1).to_numpy().view(np.uint64), bits):
                own = p // part_bits
                for k in np.unique(own):
                    parts.setdefault(int(k), np.zeros(part_bits // 8, np.uint8))
                    at = p[own == k] % part_bits
                    np.bitwise_or.at(parts[int(k)], at >> 3, (1 << (at & 7)).astype(np.uint8))
        for k, v in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()])], names=["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(v, np.uint8)
                parts[k] = parts[k] | data if k in parts else data
        for k, v in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()])], names=["part", "bits"])

    # a key's bits lie in one part, so each task of the first step makes few parts
    own = F.pmod(F.col("key"), F.lit(BLOOM_PARTS)).cast("int")
    made = keys.select(own.alias("part"), "key").repartition("part").mapInArrow(run, "part int, bits binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in made.repartition("part").mapInArrow(merge, "part int, bits binary").collect():
        out[r.part * part_bits // 8 : (r.part + 1) * part_bits // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def bloom_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    part_bits = np.uint64(bits // BLOOM_PARTS)
    base = keys % np.uint64(BLOOM_PARTS) * part_bits
    return tuple((base + (keys >> np.uint64(s)) % part_bits).astype(np.int64) for s in BLOOM_SHIFTS)


def in_bloom(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for p in bloom_places(keys, len(bits) * 8):
        out &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return out


def result_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, str, bytes]:
    """n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept, for covered ranges in any order."""
    if not len(starts):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[1:] > ends[:-1])
    a, b = starts[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)]
    kept = b"".join(data[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True))
    return len(data), int((b - a).sum()), len(a), hashlib.sha256(kept).hexdigest(), kept


def marked(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """(text, rest, runs): runs are those whose keys may repeat."""
    held = rows.sparkSession.sparkContext.broadcast(bits)  # BLOOM_MOST bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            found = runs([to_utf8(t) for t in batch.column(0).to_pylist()], roller)
            use = np.flatnonzero(in_bloom(found["key"], held.value))
            text = found["text"][use]
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1))
            parts = [found[k][use] for k in ("start", "count", "key", "place", "print")]
            kinds = (np.int32, np.int32, np.int64, np.int32, np.int64)
            arrays = [pa.array(p.view(np.int64).astype(t)) for p, t in zip(parts, kinds, strict=True)]
            packed = pa.StructArray.from_arrays(arrays, names=["start", "n", "key", "place", "print"])
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), packed)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["text", "rest", "runs"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, RUNS]))


def sort_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, key, print, at, n, bytes, twin) sorted by group -> (key, print, ranges) of windows found, but for twins."""
    held: list[tuple] = []
    size = 0

    def emit() -> pa.RecordBatch:
        _, keys, prints, at, n, data, twin = zip(*held, strict=True)
        part, first, end = repeated(list(data), np.array(n, np.int64), LENGTH)
        use = ~np.array(twin)[part]
        part, first, end = part[use], first[use], end[use]
        own = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
        shift = np.array(at, np.int64)[part]
        pairs = pa.StructArray.from_arrays([pa.array((x + shift).astype(np.int32)) for x in (first, end)], names=["a", "b"])
        ranges = pa.ListArray.from_arrays(pa.array(np.append(own, len(part)).astype(np.int32)), pairs)
        return pa.RecordBatch.from_arrays([*(pa.array(np.array(k, np.int64)[part[own]]) for k in (keys, prints)), ranges], names=["key", "print", "ranges"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= SORT_BYTES and held[-1][0] != row[0]:
                yield emit()
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield emit()


def halved(rows: Iterable[tuple], roller: Roller) -> list[tuple]:
    """Rows of hot groups -> the same windows in halves, with keys of more bytes.

    lo and hi bound the anchor's offset from a window's start; windows of a row run from offset place down.
    """
    out = []
    for group, key, print_, at, n, data, twin, place, lo, hi in rows:
        mid = (lo + hi) // 2
        sums = roller.sums(np.frombuffer(data, np.uint8))
        for a, b in ((lo, mid), (mid + 1, hi)):
            first, last = max(0, place - b), min(n - 1, place - a)  # windows whose anchor's offset is in a..b
            if first > last:
                continue
            core = (place - a, place - b + LENGTH)  # what all windows of that kind share
            part = (first, last + LENGTH)
            ends = roller.of(sums, np.array([core[0]]), np.array([core[1]]))
            new = int((ends * np.uint64(a * LENGTH + b + 1)).view(np.int64)[0])
            out.append((new, key, print_, at + first, last - first + 1, data[part[0] : part[1]], twin, place - first, a, b))
    return out


def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roller = Roller()
    for batch in batches:
        yield split_batch(halved(zip(*(c.to_pylist() for c in batch.columns), strict=True), roller))


SPLIT = "group long, key long, print long, at int, n int, bytes binary, twin boolean, place int, lo int, hi int"
SPLIT_NAMES = [c.split()[0] for c in SPLIT.split(", ")]
KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
SPLIT_TYPES = [KINDS[c.split()[1]] for c in SPLIT.split(", ")]
WANTED = ["key", "print", "start", "n", "place", "twin", "hot"]
FOUND = "key long, print long, ranges array<struct<a:int,b:int>>"


def split_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(SPLIT_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SPLIT_TYPES, strict=True)], names=SPLIT_NAMES)


def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted runs) -> their bytes; those of hot keys in halves."""
    roller = Roller()
    for batch in batches:
        want = dict(zip(WANTED, batch.column(1).flatten().flatten(), strict=True))
        start, n, hot = (want[k].to_numpy(zero_copy_only=False) for k in ("start", "n", "hot"))
        counts = pc.list_value_length(batch.column(1)).to_pylist()
        texts = chain.from_iterable(repeat(to_utf8(t), c) for t, c in zip(batch.column(0).to_pylist(), counts, strict=True))
        data = pa.array([t[a:b] for t, a, b in zip(texts, start.tolist(), (start + n + LENGTH - 1).tolist(), strict=True)], pa.binary())
        bounds = [pa.array(np.full(len(n), k, np.int32)) for k in (0, LENGTH - GRAM)]
        rows = pa.RecordBatch.from_arrays([want["key"], want["key"], want["print"], bounds[0], want["n"], data, want["twin"], want["place"], *bounds], names=SPLIT_NAMES)
        yield rows.filter(pa.array(~hot)).append_column("hot", pa.array(np.zeros(len(n) - hot.sum(), bool)))
        if hot.any():
            large = rows.filter(want["hot"])
            halves = split_batch(halved(zip(*(c.to_pylist() for c in large.columns), strict=True), roller))
            yield halves.append_column("hot", pa.array(np.ones(halves.num_rows, bool)))


def shared_windows(contents: DataFrame, hot: int, any_hot: bool) -> list[DataFrame]:
    """Tables (key, print, ranges) of what the contents of each group share. Only what is hot is counted and moved again."""
    names = ["group", "key", "print", "at", "n", "bytes", "twin"]

    def ordered(few: DataFrame) -> DataFrame:
        return settle(few.select(*names).repartition("group").sortWithinPartitions("group").mapInArrow(sort_task, FOUND), "repeat-found")

    found = [ordered(contents.filter("not hot"))]
    contents = contents.filter("hot").drop("hot")
    while any_hot:
        # what can't be halved any more is one window: all of a group's bytes are the same, and need no order
        groups = contents.groupBy("group").agg(F.count("*").alias("rows"), (F.min("bytes") == F.max("bytes")).alias("same")).filter("rows > 1")
        large = settle(contents.join(settle(groups, "repeat-groups"), "group"), "repeat-large")
        found.append(ordered(large.filter(F.col("rows") <= hot)))
        many = large.filter(F.col("rows") > hot)
        whole = many.filter("same").select("key", "print", F.array(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b"))).alias("ranges"))
        found.append(settle(whole, "repeat-found"))
        contents = settle(many.filter("not same").select(*names, "place", "lo", "hi").mapInArrow(halve, SPLIT), "repeat-halves")
        any_hot = not contents.isEmpty()
    return found


def covered(docs: DataFrame, hot: int, *kept: str) -> tuple[DataFrame, DataFrame]:
    """(text, rest) of documents in which nothing may repeat, and (text, rest, ranges) of the others."""
    small_batches(docs.sparkSession)
    rows = identified(docs, *kept)
    page = marked(rows, bloom(repeated_keys(rows))).withColumn("row", F.monotonically_increasing_id())
    page = settle(page, "repeat-marked")  # a row's number is what is written
    each = page.select("row", F.explode("runs").alias("r")).select("row", "r.*")
    place = F.struct("row", "start", "n", "place")
    contents = settle(each.groupBy("key", "print").agg(F.count("*").alias("c"), F.min(place).alias("p"), F.max(place).alias("q")), "repeat-contents")
    sizes = contents.groupBy("key").agg(F.sum("c").alias("of_key"), F.sum(F.least("c", F.lit(2))).alias("rows"))
    asked = settle(sizes.filter("of_key > 1").select("key", (F.col("rows") > hot).alias("hot")), "repeat-asked")
    any_hot = not asked.filter("hot").isEmpty()

    def copy_at(at: str, twin: bool) -> Column:
        return F.struct(F.col(f"{at}.row").alias("row"), F.struct("key", "print", f"{at}.start", f"{at}.n", f"{at}.place", F.lit(twin).alias("twin"), "hot").alias("w"))

    copies = F.when(F.col("c") > 1, F.array(copy_at("p", False), copy_at("q", True))).otherwise(F.array(copy_at("p", False)))
    wanted = contents.join(asked, "key").select(F.explode(copies).alias("x")).groupBy("x.row").agg(F.collect_list("x.w").alias("want"))  # of one row's text each
    texts = page.filter(F.size("runs") > 0).select("row", "text")
    contents_bytes = settle(texts.join(wanted, "row").select("text", "want").mapInArrow(fetch, f"{SPLIT}, hot boolean"), "repeat-bytes")
    found, *more = shared_windows(contents_bytes, hot, any_hot)
    for f in more:
        found = found.unionByName(f)
    back = each.select("row", "key", "print", "start").join(found, ["key", "print"])
    spans = back.select("row", F.transform("ranges", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"] + LENGTH - 1).alias("b"))).alias("ranges"))
    ranges = spans.groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    rest = page.filter(F.size("runs") > 0).select("row", "text", "rest").join(ranges, "row", "left")
    return page.filter(F.size("runs") == 0).select("text", "rest"), rest.select("text", "rest", "ranges")


def repeats_report(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    plain, rest = covered(docs, hot)
    plain = plain.withColumn("ranges", F.lit(None).cast("array<struct<a:int,b:int>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (x.to_numpy() for x in batch.column(2).flatten().flatten())
            cuts = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy())).tolist()
            got = [result_of(to_utf8(t), a[i:j], b[i:j])[:4] for t, i, j in zip(batch.column(1).to_pylist(), cuts, cuts[1:], strict=False)]
            columns = list(zip(*got, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = [df.select("rest.doc_id", "text", "ranges").mapInArrow(run, f"doc_id long, {RESULT}") for df in (plain, rest)]
    return done[0].unionByName(done[1])


def edges(ranges: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r["a"] for r in ranges or []], np.int64), np.array([r["b"] for r in ranges or []], np.int64)


def drop_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """docs with all repeated bytes taken out of text; rows whose text loses nothing are as they were."""
    plain, rest = covered(docs, hot, *[c for c in docs.columns if c != "text"])

    @F.pandas_udf("string")
    def cut(text, spans):  # noqa: ANN001, ANN202
        import pandas as pd

        kept = [t if s is None else result_of(to_utf8(t), *edges(list(s)))[4].decode("utf-8", "ignore") for t, s in zip(text, spans, strict=True)]
        return pd.Series(kept, dtype=object)

    columns = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return plain.select(*columns).unionByName(rest.withColumn("text", cut("text", "ranges")).select(*columns))
