"""SimHash near-duplicates by similarity: one row of each group whose five-word shingle sets are alike at 0.8 or more.

Two rows are linked if their fingerprints, of five-word shingles, are within RADIUS and the Jaccard similarity of their sets of
shingles is SHARE or more; groups are the connected components of links. At 0.8 fingerprints differ in 10 of 64 bits on average, in
12 for sets of a few shingles, and in more than RADIUS with a chance of less than one in 100,000, so the radius decides nothing that
whole sets would not: it spares their comparison.

No bands of a fingerprint are complete for such a radius, so buckets come from the sets: BANDS keys a set, each of the least of WIDTH
random orders of its shingles. Sets alike at 0.8 have a key in common with a chance of 1 - (1 - 0.8 ** 3) ** 20, all but one in 1.7 million.

1. In a bucket, or a part of HOT rows of a large one with the bucket's first node, leaders are chosen: each row is paired with the first leader
   within the radius (bit-sliced), or becomes one. Each row's most frequent leader is decided by whole sets; links make components.
2. All rows that had others in their buckets, and may have links besides, are dealt to groups by first shingles: if
   all shingles have one global order, sets of n and m shingles that are alike share one among the first n - ceil(0.8 n) + 1 and
   m - ceil(0.8 m) + 1. Rare shingles come first in that order, so rows that only have a common passage do not meet; how rare they are is counted on a sample, which has
   a say in how large groups are only. In groups that hold several components, each row is paired with the nearest of another one, again decided by whole sets, and
   this is repeated while components grow: those of many copies do so in a few rounds, and little is left to compare.
3. What groups that still hold several components connect is a cluster. In one of a bounded size its rows are dealt to parts, and every two parts meet in one task with their whole sets: pairs within
   the radius are compared there, the nearest first, until their components are one, so that links leave the task and not pairs. In groups of larger clusters, all rows of different components are
   compared, bit-sliced; in groups of more than HOT rows, the rows outside the most frequent component are compared with all, part by part. Again whole sets decide.

Edge cases: words are cut at the six ASCII spaces and A-Z is lowered; a text of fewer words than a shingle is one shingle, so null and
empty texts and those of white space are alike. Texts of any length are taken whole; a comparison holds two whole sets, eight bytes a distinct shingle. Shingles and sets are known by 64-bit hashes. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.anchors import mix
from veritrail.llm.common import batches_of, free_name, one_each, settle, small_batches
from veritrail.llm.components import components
from veritrail.llm.simhash import SEED, flips_of, lanes_beyond, lanes_set, majority, near_lanes, near_pairs, planes_of, shingle_hashes

SHINGLE, RADIUS = 5, 26
SHARE = (4, 5)  #: similarity of a link, as a fraction
BANDS, WIDTH = 20, 3
SAMPLE_DOCS, OFTEN, MAX_OFTEN = 8192, 3, 65_536  #: for the order of shingles alone: documents counted, count of a frequent shingle, shingles kept
MAX_SENT = 1 << 20  #: up to so many nodes' keys are broadcast to find their texts; more are joined
HOT = 4096  #: rows of a bucket that one task compares at a time
NEAREST_ROUNDS = 1  #: at most, before all pairs that are left are compared
TILE, MOST_TILES = 256, 16  #: rows of a part of a cluster, on average, and parts of one whose rows all meet with their sets
MOST_SHINGLES = 1 << 22  #: of all sets of such a cluster: 32 MB
LEADERS = 32  #: chosen in a bucket before the rest waits for the second step
BATCH_ROWS = 1 << 16
QUERIES = 64
CHUNK = 1 << 12  #: shingles put in their orders at a time
EMITTED = 1 << 20  #: pairs of a batch that is handed on

ORDERS = np.random.default_rng(5).integers(0, 1 << 64, BANDS * WIDTH, dtype=np.uint64) | np.uint64(1)
WEIGHTS = np.random.default_rng(8).integers(0, 1 << 64, WIDTH, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending; a text without words has one empty shingle."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def band_keys(found: np.ndarray) -> np.ndarray:
    """BANDS keys of a set: each of the least values in WIDTH orders."""
    least = np.full(BANDS * WIDTH, ~np.uint64(0))
    for k in range(0, len(found), CHUNK):
        least = np.minimum(least, (ORDERS[:, None] * found[None, k : k + CHUNK]).min(axis=1))
    return mix((least.reshape(BANDS, WIDTH) * WEIGHTS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def prefix(found: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order: by count in the sample, then by hash. often: ascending."""
    n = len(found)
    keep = n - -(-SHARE[0] * n // SHARE[1]) + 1
    if not len(often):
        return found[:keep]
    at = np.minimum(np.searchsorted(often, found), len(often) - 1)
    return found[np.lexsort((found, np.where(often[at] == found, counts[at], 0)))[:keep]]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2): 128 bits that stand for a row's id and text."""
    doc_id = F.col("doc_id").cast("long")
    text = F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), *(k.alias(f"k{i + 1}") for i, k in enumerate(keys(doc_id, text))))


def keys(doc_id: Column, text: Column) -> list[Column]:
    return [F.xxhash64(doc_id, doc_id.isNull(), text, text.isNull()), F.xxhash64(F.lit(7), text, text.isNull(), doc_id)]


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur in OFTEN texts of the sample or more, ascending, and their counts."""
    step = max(1, rows.count() // SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text).view(np.int64))], names=["token"])

    chosen = rows.filter(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text")
    counts = chosen.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
    top = counts.orderBy(F.desc("n"), "token").limit(MAX_OFTEN).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


def node_table(rows: DataFrame) -> DataFrame:
    """(node, best): a node for each distinct set; best has the key of its first row, number of shingles, fingerprint and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            fp = np.array([majority([s]) for s in sets], np.uint64).view(np.int64)
            bands = [band_keys(s).view(np.int64) for s in sets]
            n = pa.array([len(s) for s in sets], pa.int32())
            values = [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(node), n, pa.array(fp), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(values, names=["doc_id", "k1", "k2", "node", "n", "fp", "bands"])

    made = rows.mapInArrow(run, "doc_id long, k1 long, k2 long, node long, n int, fp long, bands array<long>")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "n", "fp", "bands"))
    return settle(made.groupBy("node").agg(best.alias("best")), "similar-nodes")


def may_be_alike(n: np.ndarray, m: np.ndarray, p: np.ndarray | int = 0, q: np.ndarray | int = 0) -> np.ndarray:
    """Whether sets of n and m shingles, whose first common one in the global order is at p and q, can be alike."""
    s, t = SHARE
    return (t * np.minimum(n, m) >= s * np.maximum(n, m)) & ((s + t) * np.minimum(n - p, m - q) >= s * (n + m))


def grouped(batches: Iterator[pa.RecordBatch], of: Callable) -> Iterator[pa.RecordBatch]:
    """of(table, starts, sizes) for tables of whole runs of one (token, part), from batches sorted by these."""

    def change(t: pa.Table) -> np.ndarray:
        token, part = t.column("token").to_numpy(), t.column("part").to_numpy()
        return np.flatnonzero((token[1:] != token[:-1]) | (part[1:] != part[:-1])) + 1

    def emit(t: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.append(0, cuts)
        yield from of(t, starts, np.diff(np.append(starts, t.num_rows)))

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < BATCH_ROWS:
            continue
        t = pa.Table.from_batches(held)
        cuts = change(t)
        if len(cuts):
            yield from emit(t.slice(0, int(cuts[-1])), cuts[:-1])
            held = t.slice(int(cuts[-1])).to_batches()
            rows = t.num_rows - int(cuts[-1])
    if held:
        t = pa.Table.from_batches(held)
        yield from emit(t, change(t))


ROWS = ("token", "part", "node", "n", "fp")


def bucket_rows(nodes: DataFrame, hot: int) -> DataFrame:
    """ROWS of all band keys; parts of a bucket of more than hot rows all begin with its first node."""
    rows = nodes.select(F.explode("best.bands").alias("token"), "node", F.col("best.n").alias("n"), F.col("best.fp").alias("fp"))
    large = settle(rows.groupBy("token").agg(F.count("*").alias("rows")).filter(F.col("rows") > hot), "similar-large")
    if large.isEmpty():
        return rows.withColumn("part", F.lit(0)).select(*ROWS)
    # each has more than hot rows, so there are few; a join that is dealt anew where one token holds many rows
    ones = rows.join(large, "token").groupBy("token", "rows").agg(F.min(F.struct("node", "n", "fp")).alias("one"))
    ones = settle(ones.select("token", "one", F.ceil(F.col("rows") / F.lit(hot)).cast("int").alias("parts")), "similar-firsts")
    named = rows.join(ones.select("token", "parts", F.col("one.node").alias("least")), "token", "left")
    plain = named.filter(F.col("least").isNull() | (F.col("node") != F.col("least")))
    dealt = plain.withColumn("part", F.coalesce(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.lit(0))).select(*ROWS)
    firsts = ones.select("token", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "one.*")
    return dealt.unionByName(firsts.select(*ROWS))


def led(t: pa.Table, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(a, b): pairs with leaders; and the nodes that may have links besides, b null: those of buckets of more than two, with near rows or more leaders than are chosen."""
    node, n, fp = (t.column(c).to_numpy() for c in ("node", "n", "fp"))
    bits = fp.view(np.uint64)
    group = np.repeat(np.arange(len(starts)), sizes)
    active = np.flatnonzero(np.repeat(sizes > 1, sizes))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _ in range(LEADERS):
        if not len(active):
            break
        own = group[active]
        new = np.append(True, own[1:] != own[:-1])
        lead = active[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the first row left of each bucket
        at = np.flatnonzero(~new)
        i, j = lead[at], active[at]
        hit = may_be_alike(n[i], n[j])
        hit[hit] = near_pairs(bits[i[hit]], bits[j[hit]], RADIUS)
        a.append(i[hit])
        b.append(j[hit])
        active = j[~hit]
    i, j = np.concatenate(a), np.concatenate(b)
    waits = np.zeros(len(starts), bool)
    waits[group[i]] = True
    waits[group[active]] = True
    # a part's first row may be in others too, so a part of any size may have further links
    keep = np.unique(node[np.flatnonzero((waits & ((sizes > 2) | (t.column("part").to_numpy()[starts] > 0)))[group])])
    u, v = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])
    yield pa.RecordBatch.from_arrays([pa.array(keep), pa.nulls(len(keep), pa.int64())], names=["a", "b"])


def first_pairs(nodes: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, times) of the first step, and (node) of all that wait for the others."""
    dealt = bucket_rows(nodes, hot).repartition("token", "part").sortWithinPartitions("token", "part", "node")
    with batches_of(nodes.sparkSession, 16384):
        made = settle(dealt.mapInArrow(lambda batches: grouped(batches, led), "a long, b long"), "similar-led")
    pairs = settle(made.filter(F.col("b").isNotNull()).groupBy("a", "b").agg(F.count("*").alias("times")), "similar-pairs")
    return pairs, settle(made.filter(F.col("b").isNull()).select(F.col("a").alias("node")).distinct(), "similar-waiting")


def across(nearest: bool):  # noqa: ANN201
    """Of groups: (a, b) of near rows of different components, or of each row with the nearest such."""

    def emit(node: np.ndarray, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        if nearest:
            own, other, d = np.append(i, j), np.append(j, i), np.append(d, d)
            order = np.lexsort((node[other], d, own))
            first = order[np.flatnonzero(np.diff(own[order], prepend=-1))]
            i, j = own[first], other[first]
        pairs = np.unique(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def of(t: pa.Table, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, n, p, fp, root, side = (t.column(c).to_numpy() for c in ("node", "n", "p", "fp", "root", "side"))
        bits = fp.view(np.uint64)
        size, start = np.repeat(sizes, sizes), np.repeat(starts, sizes)
        at, small = np.arange(len(node)), np.repeat(sizes <= QUERIES, sizes)
        found: list[tuple[np.ndarray, ...]] = []

        def near(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
            return i, j, np.bitwise_count(bits[i] ^ bits[j])

        for offset in range(1, QUERIES):  # many small buckets at a time: lane i is the pair (i, i + offset)
            i = np.flatnonzero(small & (at + offset < start + size))
            if not len(i):
                break
            j = i + offset
            use = (root[i] != root[j]) & ((side[i] == 0) | (side[i] != side[j])) & may_be_alike(n[i], n[j], p[i], p[j])
            i, j = i[use], j[use]
            hit = near_pairs(bits[i], bits[j], RADIUS)
            found.append(near(i[hit], j[hit]))
        if found:
            yield emit(node, *(np.concatenate(x) for x in zip(*found, strict=True)))
        for s, k in zip(starts.tolist(), sizes.tolist(), strict=True):
            if k <= QUERIES:
                continue
            found, held = [], 0
            planes, beyond = planes_of(bits[s : s + k]), lanes_beyond(k)
            ask = np.flatnonzero(side[s : s + k] < 2)
            for q in range(0, len(ask), QUERIES):
                own = ask[q : q + QUERIES]
                i, j = np.nonzero(lanes_set(near_lanes(planes, flips_of(bits[s + own]), RADIUS, beyond), k))
                i, j = s + own[i], s + j
                use = (root[i] != root[j]) & ((side[i] == 0) | (side[j] == 2)) & may_be_alike(n[i], n[j], p[i], p[j])
                if not nearest:
                    use &= (i < j) | (side[j] == 2)
                found.append(near(i[use], j[use]))
                held += int(use.sum())
                if held > EMITTED and not nearest:
                    yield emit(node, *(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, held = [], 0
            if found:
                yield emit(node, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return of


LIVE = ("token", "part", "node", "n", "p", "fp", "root", "side")


def first_shingles(rows: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, p, node, n, fp): a row for each of the first shingles of each set, those that no other set has left out."""
    often, counts = frequent(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy().view(np.uint64)
            first = [prefix(found[a:b], often, counts).view(np.int64) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.list_(pa.int64()))], names=["node", "first"])

    firsts = settle(sets.mapInArrow(run, "node long, first array<long>"), "similar-firsts")
    shared = firsts.select(F.explode("first").alias("token")).groupBy("token").agg(F.count("*").alias("rows")).filter("rows > 1").select("token")
    each = firsts.select("node", F.posexplode("first").alias("p", "token")).join(shared, "token")
    return settle(each.join(nodes.select("node", F.col("best.n").alias("n"), F.col("best.fp").alias("fp")), "node"), "similar-shingles")


def alive_rows(shingles: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, node, n, p, fp, root, rows) of the groups that hold several components; rows: of the group."""
    named = shingles.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = named.groupBy("token").agg(F.count("*").alias("rows"), F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 < r1").select("token", "rows")
    return settle(named.join(settle(sizes, "similar-live"), "token"), "similar-alive")


def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): links that join the components of each tile's rows, decided by whole sets; from batches sorted by (cluster, x, y)."""
    for t in tables(batches, ("cluster", "x", "y")):
        node, n, fp, root, side = (t.column(c).to_numpy() for c in ("node", "n", "fp", "root", "part"))
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        own, other = np.flatnonzero(side == x), np.flatnonzero(side == y)
        sets = [s.values.to_numpy().view(np.uint64) for s in t.column("found")]
        up = {r: r for r in root.tolist()}

        def top(r: int, up: dict[int, int] = up) -> int:
            while up[r] != r:
                up[r] = r = up[up[r]]
            return r

        found = []
        for k in range(0, len(own), QUERIES):
            i, j = (z.ravel() for z in np.meshgrid(own[k : k + QUERIES], other, indexing="ij"))
            use = (root[i] != root[j]) & may_be_alike(n[i], n[j])
            if x == y:
                use &= i < j
            i, j = i[use], j[use]
            far = np.bitwise_count(fp[i].view(np.uint64) ^ fp[j].view(np.uint64))
            order = np.argsort(far, kind="stable")
            order = order[: np.searchsorted(far[order], RADIUS, "right")]
            for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):  # the nearest first, so that components are soon one
                p, q = top(int(root[a])), top(int(root[b]))
                if p == q:
                    continue
                common = np.searchsorted(sets[a], sets[b], "right") - np.searchsorted(sets[a], sets[b], "left")
                if (SHARE[0] + SHARE[1]) * int(common.sum()) >= SHARE[0] * (len(sets[a]) + len(sets[b])):
                    up[max(p, q)] = min(p, q)
                    found.append((int(node[a]), int(node[b])))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["u", "v"])


def tables(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The runs of rows with the same keys, of batches sorted by them; a run is held whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            key = tuple(v[a] for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def tile_links(alive: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links (u, v) of the clusters of a bounded size, nodes of larger ones).

    A cluster is what groups that still hold several components connect. Its rows are dealt to parts of TILE rows, and every two parts meet in one task with their whole sets,
    each row with as many others as there are parts: MOST_TILES at most.
    """
    least = alive.groupBy("token").agg(F.min("node").alias("v"))
    edges = alive.select("token", F.col("node").alias("u")).join(least, "token").filter("u <> v").select("u", "v").distinct()
    clusters = components(settle(edges, "similar-edges"))
    nodes = alive.select("node", "n", "fp", "root").distinct().join(clusters.select(F.col("u").alias("node"), F.col("v").alias("cluster")), "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    nodes = settle(nodes, "similar-clustered")
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("parts"), F.sum("n").alias("weight"))
    fits = (F.col("parts") <= MOST_TILES) & (F.col("weight") <= MOST_SHINGLES)
    sizes = settle(sizes.withColumn("fits", fits), "similar-clusters")
    named = nodes.join(sizes, "cluster")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = named.filter("fits").withColumn("part", part).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("cluster", F.least("part", "o").alias("x"), F.greatest("part", "o").alias("y"), "part", "node", "n", "fp", "root")
    whole = dealt.join(sets, "node").repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")
    with batches_of(alive.sparkSession, 1024):
        links = settle(whole.mapInArrow(tiled, "u long, v long"), "similar-tiles")
    return links, settle(named.filter(~F.col("fits")).select("node"), "similar-large-clusters")


def cross_pairs(alive: DataFrame, hot: int, nearest: bool) -> DataFrame:
    """(a, b) of candidates across components, in groups that hold several."""
    out = alive.filter(F.col("rows") <= hot).withColumns({"part": F.lit(0).cast("long"), "side": F.lit(0)}).select(*LIVE)
    large = alive.filter(F.col("rows") > hot)
    if not large.isEmpty():
        parts = F.ceil(F.col("rows") / F.lit(hot))
        own = F.pmod(F.xxhash64("node"), parts)
        if nearest:  # a row's nearest of its part will do
            out = out.unionByName(large.withColumns({"part": own, "side": F.lit(0)}).select(*LIVE))
        else:  # rows outside the main component meet each other in the first part, and the others in all
            main = large.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"))
            told = large.join(main, "token")
            inside = told.filter(F.col("root") == F.col("main")).withColumns({"part": own, "side": F.lit(2)})
            outside = told.filter(F.col("root") != F.col("main")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            out = out.unionByName(inside.select(*LIVE)).unionByName(outside.withColumn("side", (F.col("part") > 0).cast("int")).select(*LIVE))
    dealt = out.repartition("token", "part").sortWithinPartitions("token", "part", "node")
    of = across(nearest)
    with batches_of(alive.sparkSession, 16384):
        return settle(dealt.mapInArrow(lambda batches: grouped(batches, of), "a long, b long").distinct(), "similar-cross")


def sets_of(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, found): the whole sets of the nodes in wanted."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "found"])

    at = few(nodes.join(wanted, "node", "left_semi").select("node", "best.k1", "best.k2"))
    texts = rows.select("k1", "k2", "text").join(at, ["k1", "k2"]).select("node", "text")
    return settle(texts.mapInArrow(run, "node long, found array<long>").dropDuplicates(["node"]), "similar-sets")  # rows may be repeated


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of the pairs whose sets are alike. Only the sets asked for are dealt."""
    s, t = SHARE
    a, b = (sets.join(few(pairs.select(F.col(c).alias("node")).distinct()), "node").select(F.col("node").alias(c), F.col("found").alias(f"of_{c}")) for c in ("a", "b"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return settle(both.filter((s + t) * common >= s * (F.size("of_a") + F.size("of_b"))).select(F.col("a").alias("u"), F.col("b").alias("v")), "similar-links")


def few(keys: DataFrame) -> DataFrame:
    """keys with a hint to broadcast them if they are at most MAX_SENT rows, else to join by sorting."""
    keys = settle(keys, "similar-keys")
    return keys.hint("broadcast" if keys.count() <= MAX_SENT else "merge")


def between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    of = {c: roots.select(F.col("u").alias(c), F.col("v").alias(f"root_{c}")) for c in ("a", "b")}
    named = pairs.join(of["a"], "a", "left").join(of["b"], "b", "left")
    return named.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def groups(rows: DataFrame, nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """(u, v): v is the smallest node of u's group, for all nodes of groups but the smallest."""
    pairs, waiting = first_pairs(nodes, hot)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets_of(rows, nodes, ends.unionByName(waiting).distinct())
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a")).select("a", "b")
    roots = components(alike(settle(best, "similar-best"), sets))
    # a pair of the first step that is not in one component yet is among those found by first shingles, if it is alike
    open_ = between(pairs.select("a", "b"), roots).select(F.explode(F.array("a", "b")).alias("node"))
    shingles = first_shingles(rows, nodes, sets.join(few(waiting.unionByName(open_).distinct()), "node"))
    for _ in range(NEAREST_ROUNDS):
        more = alike(cross_pairs(alive_rows(shingles, roots), hot, nearest=True), sets)
        if more.isEmpty():
            break
        roots = joined(roots, more)
    alive = alive_rows(shingles, roots)
    if alive.isEmpty():
        return roots
    links, large = tile_links(alive, sets)
    if not large.isEmpty():
        links = links.unionByName(alike(cross_pairs(settle(alive.join(large, "node", "left_semi"), "similar-large-alive"), hot, nearest=False), sets))
    return roots if links.isEmpty() else joined(roots, links)


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots after further links: components of components, which are few."""
    of = lambda c: roots.select(F.col("u").alias(c), F.col("v").alias(f"root_{c}"))
    named = links.join(of("u"), "u", "left").join(of("v"), "v", "left")
    above = components(named.select(F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v")).distinct())
    up = above.select(F.col("u").alias("v"), F.col("v").alias("up"))
    moved = roots.join(up, "v", "left").select("u", F.coalesce("up", "v").alias("v"))
    return settle(moved.unionByName(above), "similar-roots")


def drop_similar(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The rows of docs without those that are like another at SHARE: of each group one row stays, of the smallest id, nulls last.

    Rows with the same id and text are ordered by their other columns.
    """
    rows = keyed(docs)
    small_batches(docs.sparkSession)
    nodes = node_table(rows)
    roots = groups(rows, nodes, hot)
    of = nodes.select("node", F.struct("best.no_id", "best.doc_id", "best.k1", "best.k2").alias("best")).join(roots.withColumnRenamed("u", "node"), "node", "left")
    keep = settle(of.groupBy(F.coalesce("v", "node").alias("root")).agg(F.min("best").alias("best")).select("best.k1", "best.k2"), "similar-keep")
    k1, k2 = free_name(docs, "k1"), free_name(docs, "k2")
    own = keys(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = docs.withColumns({k1: own[0], k2: own[1]})
    # both sides grow with the corpus, so the keys are not broadcast even while they are few: one plan at every size
    kept = marked.join(keep.select(F.col("k1").alias(k1), F.col("k2").alias(k2)).hint("merge"), [k1, k2], "left_semi")
    return one_each(kept, [k1, k2], [c for c in docs.columns if c not in ("doc_id", "text")]).select(*(F.col(f"`{c}`") for c in docs.columns))
