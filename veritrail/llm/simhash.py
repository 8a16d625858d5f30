"""SimHash near-duplicates: fingerprints of word shingles, linked within a radius by bit-sliced comparison.

Rows with one fingerprint are one node from the start. Fingerprints within the radius of 2 agree on at
least two of four 16-bit bands, so each node goes to six buckets, one for each pair of bands. In a
bucket, bit planes stand vertically: bit i of 64 fingerprints is one machine word, a query's XOR
with a plane is added to counters by carry-save logic, and a word of lanes is left as soon as all its distances
exceed the radius. A bucket gives only a star of links for each of its groups. Buckets of more than
HOT nodes are dealt anew by thirds of their other 32 bits, of which one must agree too, and what is still
larger goes to several tasks as pairs of blocks; no link is lost.

Edge cases: a null or empty text, or one of white space only, has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle. Rows with the same id stand for one document: both
are returned, and stay or go together. Texts of any length are read whole, CHUNK shingles at a time. Further columns are ignored by near_duplicates() and kept
by drop_near_duplicates(). An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import batches_of, free_name, one_each, settle, small_batches
from veritrail.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
BANDS, BAND_BITS = 4, 16
HOT = 4096
CHUNK = 1 << 16  #: shingles counted at a time
BATCH_ROWS = 1 << 16  #: bucket rows compared at a time, besides the rest of the last bucket
SMALL = 64  #: buckets up to this size are compared many at a time

#: A byte as eight counters of a byte each.
LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, CHUNK at a time; none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    line = b" ".join(words)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(first[k : k + CHUNK], last[k : k + CHUNK], strict=True)], "<u8")


def majority(parts: Iterable[np.ndarray]) -> int:
    """64 bits, each set in over half of the hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        lanes = LANES[hashes.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)  # at most 255 in a counter
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def planes_of(x: np.ndarray) -> np.ndarray:
    """(64, words): word w of plane b holds bit b of fingerprints 64 w to 64 w + 63."""
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(x) % 64
    return np.ascontiguousarray(np.packbits(np.pad(bits, ((0, pad), (0, 0))).T, axis=1, bitorder="little")).view("<u8")


def near_lanes(planes: np.ndarray, flips: np.ndarray | None, radius: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Lanes whose distance is at most radius; planes: (64, words), flips: (queries, 64) words of ones or zeros.

    Counters are bit-sliced too: counter[k] holds bit k of every lane's distance so far, over its overflow. A block is a word of
    lanes for one query; blocks all of whose lanes exceed the radius are left, and only those still alive go on.
    skip: lanes out of the question, which don't keep a block alive.
    """
    words = planes.shape[1]
    if flips is None:
        flips = np.zeros((1, 64), np.uint64)
    n = len(flips) * words
    width = max(1, int(radius + 1).bit_length())
    counter = [np.zeros(n, np.uint64) for _ in range(width)]
    over = np.zeros(n, np.uint64) if skip is None else np.broadcast_to(skip, (len(flips), words)).ravel().copy()
    out = np.zeros(n, np.uint64)
    alive = of = at = None
    for b in range(64):
        carry = (planes[b][None, :] ^ flips[:, b, None]).ravel() if alive is None else planes[b][at] ^ flips[of, b]
        for k in range(width):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b >= radius and b % 8 == 7 and b < 63:
            left = np.flatnonzero(~(over | greater(counter, radius)))
            if not len(left):
                return out.reshape(-1, words)
            if 2 * len(left) < len(over):
                alive = left if alive is None else alive[left]
                of, at = np.divmod(alive, words)
                counter, over = [c[left] for c in counter], over[left]
    near = ~(over | greater(counter, radius))
    if alive is None:
        return near.reshape(-1, words)
    out[alive] = near
    return out.reshape(-1, words)


def lanes_beyond(n: int) -> np.ndarray:
    """Words of lanes with those set that stand for none of n."""
    out = np.zeros(-(-n // 64), np.uint64)
    if n % 64:
        out[-1] = ~np.uint64(0) << np.uint64(n % 64)
    return out


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether a[i] and b[i] differ in radius bits at most: lane i is pair i."""
    if not len(a):
        return np.zeros(0, bool)
    return lanes_set(near_lanes(planes_of(a ^ b), None, radius, lanes_beyond(len(a)))[0], len(a)).astype(bool)


def flips_of(x: np.ndarray) -> np.ndarray:
    """(queries, 64): a word of ones for each bit set."""
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    return np.where(bits, ~np.uint64(0), np.uint64(0))


def greater(counter: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose counter is above limit."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ~np.uint64(0))
    for k in range(len(counter) - 1, -1, -1):
        if limit >> k & 1:
            same &= counter[k]
        else:
            more |= same & counter[k]
            same &= ~counter[k]
    return more


def lanes_set(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")[..., :n]


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's group, given links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        was = label.copy()
        for x in (a, b):
            np.minimum.at(label, x, least)
            np.minimum.at(label, was[x], least)
        label = label[label]
        if (label == was).all():
            break
    return label


def links(x: np.ndarray, group: np.ndarray, block: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of x (sorted by group) the index of its group's smallest reachable member.

    block: 0 for plain groups; in a pair of blocks, 1 and 2, and only 1 against 2 is compared.
    """
    n = len(x)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, n))
    size = np.repeat(sizes, sizes)
    pairs_a, pairs_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = np.flatnonzero((size > 1) & (size <= SMALL) & (block == 0))
    if len(small):  # many groups at once: lane i is the pair (i, i + offset)
        y, g = x[small], group[small]
        for offset in range(1, int(size[small].max())):
            same = np.flatnonzero(g[offset:] == g[:-offset])
            if not len(same):
                break
            hit = near_pairs(y[same], y[same + offset], radius)
            pairs_a.append(small[same[hit]])
            pairs_b.append(small[same[hit] + offset])
    for s, k in zip(starts, sizes, strict=True):
        if k > SMALL or block[s]:
            a, b = compare(x[s : s + k], block[s : s + k], radius)
            pairs_a.append(a + s)
            pairs_b.append(b + s)
    return stars(n, np.concatenate(pairs_a), np.concatenate(pairs_b))


def compare(x: np.ndarray, block: np.ndarray, radius: int, queries: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Star links of one large group, block of queries after block."""
    n = len(x)
    paired = bool(block[0])
    planes = planes_of(x)
    label = np.arange(n)
    ask = np.flatnonzero(block == 1) if paired else np.arange(n)
    others = np.packbits(np.pad(block != 2, (0, -n % 64), constant_values=True), bitorder="little").view("<u8") if paired else lanes_beyond(n)
    word = np.arange(planes.shape[1])
    for k in range(0, len(ask), queries):
        q = ask[k : k + queries]
        skip = np.repeat(others[None, :], len(q), axis=0)
        if not paired:  # a query's own lane and those before it
            skip[word[None, :] < (q // 64)[:, None]] = ~np.uint64(0)
            skip[np.arange(len(q)), q // 64] |= ~np.uint64(0) >> (63 - q % 64).astype(np.uint64)
        at, lane = np.nonzero(lanes_set(near_lanes(planes, flips_of(x[q]), radius, skip), n))
        rest = np.flatnonzero(label != np.arange(n))
        label = stars(n, np.concatenate([q[at], rest]), np.concatenate([lane, label[rest]]))
    rest = np.flatnonzero(label != np.arange(n))
    return rest, label[rest]


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(fp, key, rest) six times a node: key is a pair of bands with its number, rest the other 32 bits."""
    band = [F.call_function("shiftrightunsigned", F.col("fp"), F.lit(BAND_BITS * i)).bitwiseAND(0xFFFF) for i in range(BANDS)]
    pairs = [(i, j) for i in range(BANDS) for j in range(i + 1, BANDS)]
    out = []
    for k, (i, j) in enumerate(pairs):
        p, q = (m for m in range(BANDS) if m not in (i, j))
        key = (F.lit(k).cast("long") * (1 << 32)) + band[i] * (1 << 16) + band[j]
        out.append(F.struct(key.alias("key"), (band[p] * (1 << 16) + band[q]).alias("rest")))
    return nodes.select("fp", F.explode(F.array(*out)).alias("b")).select("fp", "b.key", "b.rest")


def deal(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """(fp, k1, k2, k3, block): groups of at most about hot rows, or two blocks of hot rows each."""
    sizes = settle(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-buckets")
    plain = rows.join(sizes.filter(F.col("n") <= hot).select("key"), "key", "left_semi")
    out = plain.select("fp", F.col("key").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit(0).alias("block"))
    large = sizes.filter(F.col("n") > hot)
    if large.isEmpty():
        return out
    thirds = [(0, 0x7FF), (11, 0x7FF), (22, 0x3FF)]
    parts = F.array(*[F.lit(k * (1 << 11)).cast("long") + F.shiftright("rest", s).bitwiseAND(m) for k, (s, m) in enumerate(thirds)])
    again = rows.join(large.select("key"), "key", "left_semi").select("fp", F.col("key").alias("k1"), F.explode(parts).alias("k2"))
    again = settle(again, "simhash-large")
    n = again.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1")
    again = again.join(n, ["k1", "k2"])
    out = out.unionByName(again.filter(F.col("n") <= hot).select("fp", "k1", "k2", F.lit(0).cast("long").alias("k3"), F.lit(0).alias("block")))
    blocks = F.ceil(F.col("n") / hot)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    others = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct((F.least(mine, o) * (1 << 31) + F.greatest(mine, o)).alias("k3"), F.when(mine == o, 0).when(mine < o, 1).otherwise(2).alias("block")))
    split = again.filter(F.col("n") > hot).select("fp", "k1", "k2", F.explode(others).alias("o"))
    return out.unionByName(split.select("fp", "k1", "k2", "o.k3", "o.block"))


def link_table(nodes: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(u, v) links between fingerprints such that all within the radius are connected; the buckets hold all up to RADIUS."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"a radius of {radius}: two of four bands and one of three parts agree for certain only up to {RADIUS}")
    rows = deal(bucket_rows(nodes), hot)
    keys = ["k1", "k2", "k3"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(t: pa.Table) -> pa.RecordBatch:
            fp, k1, k2, k3, block = (t.column(c).to_numpy() for c in ("fp", *keys, "block"))
            change = np.concatenate([[False], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (k3[1:] != k3[:-1])])
            root = links(fp.view(np.uint64), np.cumsum(change), block, radius)
            use = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(fp[use]), pa.array(fp[root[use]])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held)
            if t.num_rows < BATCH_ROWS:
                continue
            k1, k2, k3 = (t.column(c).to_numpy() for c in keys)
            same = (k1 == k1[-1]) & (k2 == k2[-1]) & (k3 == k3[-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield emit(t.slice(0, cut))
                held = t.slice(cut).to_batches()
        if held:
            yield emit(pa.Table.from_batches(held))

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "fp")
    with batches_of(nodes.sparkSession, 16384):
        return settle(dealt.mapInArrow(run, "u long, v long").distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; radius: at most RADIUS."""
    prints = settle(fingerprints(docs, shingle), "simhash")
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(link_table(nodes.select("fp"), radius))  # (u, v)
    of = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("fp", F.coalesce("v", "fp").alias("root"), "least")
    firsts = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(firsts, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with the columns of docs; one row for each of its texts."""
    found = near_duplicates(docs)
    keep = settle(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("keep_id")).distinct(), "simhash-keep")
    # both sides grow with the corpus, so the ids are not broadcast even while they are few: one plan at every size
    kept = docs.join(keep.hint("merge"), docs["doc_id"].eqNullSafe(keep["keep_id"]), "left_semi")
    k1, k2 = free_name(docs, "k1"), free_name(docs, "k2")
    marked = kept.withColumns({k1: F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()), k2: F.xxhash64(F.lit(7), "text", "doc_id")})
    return one_each(marked, [k1, k2], [c for c in docs.columns if c not in ("doc_id", "text")])
