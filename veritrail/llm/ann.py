"""Nearest neighbours by randomly rotated one-bit codes, with error bounds and exact reranking.

A unit vector is filled up with zeros to CODE_BITS components, if it has fewer, rotated by a random orthogonal matrix and kept as the signs of its
coordinates, packed in 64-bit words, and one correction scalar: its inner product with its own sign vector. A rotated query is rounded to QUERY_BITS bits, and its inner products with all codes come from bit planes: and, population count, shift. Divided by the
scalar, that estimates the cosine without bias; the error is bounded by BOUND times its standard deviation.

1. Equal vectors are one: of each, the K + 1 rows of the smallest ids are kept, as no others can be among the nearest. Codes of the distinct vectors
   and bit planes of the distinct queries are made once, and written.
2. The queries are a stated set (every QUERY_STEP-th id), compared with all codes in blocks: blocks of codes of bounded size meet blocks of
   queries of bounded size under one key. Nothing but codes moves. A block returns the best FIRST * K estimates of a query; the best of all blocks are
   compared exactly, by vectors fetched by key, and give the score to beat.
3. The blocks meet again and return every code whose upper bound reaches that score. These are compared exactly too.

Nothing is broadcast; vectors are known by 64-bit hashes; only the lengths of query vectors are collected, with their numbers.

Nearness is the cosine in double precision on the original vectors, each scaled by a power of two, which changes no digit, so that norms don't
overflow; equal scores go to the smaller vec_id. Vectors that are null, zero, or hold a null or non-finite component take no part. Rows that repeat an id
take part each, and each is answered as a query; a row is no candidate for itself alone. Rows with a null id take no part. Vectors of another length than
the query's take no part in its search. Vectors may be of any length; the time and memory of one's code grow in proportion, but for a logarithm. An empty table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import batches_of, process_store, settle

QUERY_STEP, K = 50, 5
CODE_BITS = 512  #: at least; the error of an estimate falls with their root
QUERY_BITS = 4
DENSE, ROTATIONS = 2048, 8  #: components of a vector that a matrix turns, and matrices that a worker keeps: 32 MB each at most
BOUND = 2.5  #: standard deviations
FIRST = 8  #: times k, the number of best estimates that set the score to beat
ROWS, QUERIES = 32_768, 32_768  #: largest blocks, on average: some MB of codes and of queries
SEED = 6
TILE = 64  #: queries estimated at a time
CODES_AT_ONCE = 8192
PAIRS_AT_ONCE = 8192  #: vectors compared exactly at a time

CODED = "key long, d int, words binary, ones int, own double, planes binary, low double, step double, total long"


def code_bits(d: int) -> int:
    return max(CODE_BITS, -(-d // 64) * 64) if d <= DENSE else 1 << (d - 1).bit_length()


def rotation(d: int) -> np.ndarray:
    """The first d rows of a random orthogonal matrix of code_bits(d), the same everywhere."""
    n = code_bits(d)
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, n)))
    return (q * np.sign(np.diag(r)))[:d]


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows, filled up to code_bits, turned at random: by a matrix that a worker makes once for each of the last few lengths, and beyond
    DENSE components by three rounds of random signs and a Walsh-Hadamard transform, which take no matrix."""
    d = x.shape[1]
    if d <= DENSE:
        known = process_store().setdefault("rotations", {})
        if d not in known:
            while len(known) >= ROTATIONS:
                del known[next(iter(known))]
            known[d] = rotation(d)
        return x @ known[d]
    n = code_bits(d)
    out = np.zeros((len(x), n))
    out[:, :d] = x
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (3, n))
    for turn in signs:
        out *= turn
        half = 1
        while half < n:
            pairs = out.reshape(len(x), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
            half *= 2
        out /= np.sqrt(n)
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that the largest component is between 0.5 and 1."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def packed(bits: np.ndarray) -> np.ndarray:
    """(rows, words) of 64 bits."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray) -> dict[str, np.ndarray]:
    """Of vectors (rows): code words, their number of ones, correction scalars; and as queries, bit planes, range and sums of levels."""
    x = scaled(x)
    turned = rotated(x / np.sqrt((x * x).sum(axis=1))[:, None])
    low = turned.min(axis=1)
    step = np.maximum(turned.max(axis=1) - low, 1e-300) / (2**QUERY_BITS - 1)
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    planes = np.stack([packed((level >> b) & 1) for b in range(QUERY_BITS)], axis=1)
    return {"words": packed(turned > 0), "ones": (turned > 0).sum(axis=1), "own": np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]), "planes": planes, "low": low, "step": step, "total": level.sum(axis=1, dtype=np.int64)}


def estimate(q: dict[str, np.ndarray], x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, error bounds) of the cosines of queries (rows) with codes (columns)."""
    n_words = x["words"].shape[1]
    bits = 64 * n_words
    total = np.zeros((len(q["low"]), len(x["ones"])), np.int32)
    for b in range(QUERY_BITS):
        common = np.zeros(total.shape, np.uint16)
        for w in range(n_words):
            common += np.bitwise_count(q["planes"][:, b, w, None] & x["words"][None, :, w])
        total += common.astype(np.int32) << b
    # sum of s_i q_i over signs s = 2 x - 1, with q_i = low + step * level_i
    all_ = q["low"] * bits + q["step"] * q["total"]
    product = (2 * (q["low"][:, None] * x["ones"][None, :] + q["step"][:, None] * total) - all_[:, None]) / np.sqrt(bits)
    variance = np.maximum(1 - x["own"] ** 2, 0)[None, :] / (bits - 1) + q["step"][:, None] ** 2 / 12  # of the code, of the query's rounding
    return product / x["own"][None, :], BOUND * np.sqrt(variance) / x["own"][None, :]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows in double precision, each pair by itself, so that equal vectors get equal scores."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, key, d): of vectors that take part; key stands for the vector's content."""
    v = F.col("embedding")
    x = F.transform(v, lambda c: c.cast("double"))
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False)))
    return rows.withColumns({"key": F.xxhash64("v"), "d": F.size("v")})


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with one value of d each."""
    d = batch.column("d").to_numpy()
    for k in np.unique(d):
        yield batch.filter(pa.array(d == k))


def coded(distinct: DataFrame) -> DataFrame:
    """CODED of (key, d, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_length(whole):
                c = encode(matrix(batch.column("v")))
                blobs = {k: pa.array([r.tobytes() for r in c[k]], pa.binary()) for k in ("words", "planes")}
                values = [batch.column("key"), batch.column("d"), blobs["words"], pa.array(c["ones"].astype(np.int32)), pa.array(c["own"]), blobs["planes"], pa.array(c["low"]), pa.array(c["step"]), pa.array(c["total"])]
                yield pa.RecordBatch.from_arrays(values, names=[f.split()[0] for f in CODED.split(", ")])

    return distinct.select("key", "d", "v").mapInArrow(run, CODED)


def blocked(codes: DataFrame, asked: DataFrame, sizes: list, rows: int, queries: int) -> DataFrame:
    """Blocks (d, a, b) of codes and queries in one table: words and planes of the side that a row is not of are null."""
    out = None
    for d, n, m in sizes:
        n_a, n_b = max(1, -(-n // rows)), max(1, -(-m // queries))
        block = lambda k: F.pmod(F.xxhash64("key", F.lit(9)), F.lit(k)).cast("int")
        spread = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
        x = codes.filter(F.col("d") == d).select("d", block(n_a).alias("a"), spread(n_b).alias("b"), "key", "words", "ones", "own", *[F.lit(None).cast(t).alias(c) for c, t in (("planes", "binary"), ("low", "double"), ("step", "double"), ("total", "long"), ("beat", "double"))])
        q = asked.filter(F.col("d") == d).select("d", spread(n_a).alias("a"), block(n_b).alias("b"), "key", *[F.lit(None).cast(t).alias(c) for c, t in (("words", "binary"), ("ones", "int"), ("own", "double"))], "planes", "low", "step", "total", "beat")
        both = x.unionByName(q)
        out = both if out is None else out.unionByName(both)
    return out


def compare(k: int):  # noqa: ANN201
    """Of a block: (query, key, about) of the best FIRST * k estimates, or where beat is known all that may reach it."""

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("planes").is_valid().to_numpy(zero_copy_only=False)
        codes, ask = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
        found: list[tuple[np.ndarray, ...]] = []
        if codes.num_rows and ask.num_rows:
            words = np.frombuffer(b"".join(codes.column("words").to_pylist()), "<u8").reshape(codes.num_rows, -1)
            planes = np.frombuffer(b"".join(ask.column("planes").to_pylist()), "<u8").reshape(ask.num_rows, QUERY_BITS, -1)
            x = {"words": words, "ones": codes.column("ones").to_numpy(), "own": codes.column("own").to_numpy()}
            q = {"planes": planes} | {c: ask.column(c).to_numpy() for c in ("low", "step", "total")}
            keys, own, beat = codes.column("key").to_numpy(), ask.column("key").to_numpy(), ask.column("beat").to_numpy()
            for t in range(0, len(own), TILE):
                part = {c: v[t : t + TILE] for c, v in q.items()}
                best: list[tuple[np.ndarray, ...]] = []
                for s in range(0, len(keys), CODES_AT_ONCE):
                    about, error = estimate(part, {c: v[s : s + CODES_AT_ONCE] for c, v in x.items()})
                    if np.isnan(beat[t]):
                        m = min(FIRST * k, about.shape[1])
                        at = np.argpartition(-about, m - 1, axis=1)[:, :m]
                        i = np.repeat(np.arange(len(about)), m)
                        j = at.ravel()
                    else:
                        i, j = np.nonzero(about + error >= beat[t : t + TILE, None])
                    best.append((own[t + i], keys[s + j], about[i, j]))
                found.append(tuple(np.concatenate(c) for c in zip(*best, strict=True)))
        out = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({c: pa.array(v) for c, v in zip(("query", "key", "about"), out, strict=True)})

    return run


def scores(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(query, key, score): exact cosines of pairs of distinct vectors, fetched by their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_length(whole):
                score = cosines(matrix(batch.column("of_query")), matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("key"), pa.array(score)], names=["query", "key", "score"])

    both = pairs.select("query", "key").join(distinct.select("key", "d", "v"), "key")
    both = both.join(distinct.select(F.col("key").alias("query"), F.col("v").alias("of_query")), "query")
    with batches_of(pairs.sparkSession, PAIRS_AT_ONCE):
        return settle(both.select("query", "key", "d", "v", "of_query").mapInArrow(run, "query long, key long, score double"), "near-scores")


def top(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group; Spark limits groups before they are shuffled."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_at", at).filter(F.col("_at") <= n).drop("_at")


def nearest(vectors: DataFrame, k: int = K, step: int = QUERY_STEP, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    numbered = settle(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "near-rows")  # a row's number is what is written
    kept = settle(top(numbered, ["key"], ["vec_id", "row"], k + 1), "near-kept")
    distinct = settle(top(kept, ["key"], ["vec_id", "row"], 1), "near-distinct")
    asking = numbered.filter(F.pmod("vec_id", F.lit(step)) == 0).select(F.col("vec_id").alias("query_id"), "row", F.col("key").alias("query"))
    with batches_of(spark, CODES_AT_ONCE):
        codes = settle(coded(distinct), "near-codes")
    asked = settle(codes.join(asking.select(F.col("query").alias("key")).distinct(), "key", "left_semi"), "near-asked")
    counts = codes.groupBy("d").agg(F.count("*").alias("n")).join(asked.groupBy("d").agg(F.count("*").alias("m")), "d")
    sizes = [(r.d, r.n, r.m) for r in counts.collect()]  # a row for each length of query vectors
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    schema = "query long, key long, about double"
    blocks = blocked(codes, asked.withColumn("beat", F.lit(float("nan"))), sizes, rows, queries)
    about = blocks.groupBy("d", "a", "b").applyInArrow(compare(k), schema)
    first = scores(settle(top(about, ["query"], [F.desc("about"), "key"], FIRST * k), "near-first"), distinct)
    # of the distinct vectors found, the k + 1 best hold the k best rows besides the query's own
    beat = top(first, ["query"], [F.desc("score"), "key"], k + 1).groupBy("query").agg(F.when(F.count("*") > k, F.min("score")).otherwise(-2.0).alias("beat"))
    again = blocked(codes, asked.join(beat.withColumnRenamed("query", "key"), "key"), sizes, rows, queries)
    more = again.groupBy("d", "a", "b").applyInArrow(compare(k), schema).select("query", "key").join(first, ["query", "key"], "left_anti")
    found = first.unionByName(scores(settle(more, "near-more"), distinct))
    least = kept.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("rows"))  # k + 1 at most
    named = found.join(least.withColumn("least", F.col("rows")[0]["vec_id"]), "key")
    near = top(named, ["query"], [F.desc("score"), "least", "key"], k + 1).select("query", "score", F.explode("rows").alias("r"))
    order = F.struct((-F.col("score")).alias("down"), F.col("r.vec_id").alias("vec_id"), F.col("r.row").alias("row"), "score")
    lists = settle(near.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(order)), 1, k + 1).alias("near")), "near-lists")  # (k + 1) ** 2 at most
    answered = asking.join(lists, "query").select("query_id", F.slice(F.filter("near", lambda c: c["row"] != F.col("row")), 1, k).alias("near"))
    flat = answered.select("query_id", F.posexplode("near").alias("at", "c"))
    return flat.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))
