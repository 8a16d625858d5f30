"""Phrases mined level by level (Apriori), scored by their weakest cut.

A phrase of k words can be frequent only if its first and its last k - 1 words are. So one pass over the texts for each length
emits a k-gram only where both of these are known to be frequent, counts the k-grams, and keeps the frequent ones as the next level. A frequent
k-gram has a number; a text is carried as the numbers of the (k-1)-grams at its places (-1: none), so a k-gram is a pair of numbers and
no count rests on a hash. Pairs are summed within tasks before they are shuffled. Level tables (number, phrase, count, counts of
all beginnings and ends) are joined from one level to the next, so each cut's parts are looked up, not counted again.

What is broadcast is the keys of one level, at most SENT of them at a time: where a level has more, its keys are dealt by number to several passes,
each filling in its part of the places. The driver holds one such part, never a whole level.

Edge cases: a null text is empty, a null lang is "und". Empty pieces and pieces of one word give words, but no longer phrases. Repeated rows count each time.
Languages are counted apart, however many there are. An empty table gives no rows. Further columns of documents are ignored. Texts of any length are taken whole:
one text's words are in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import batches_of, settle

LEAST = 100  #: occurrences of a candidate
MOST_WORDS = 5
FIRST = 2000  #: of each language
SHARE = 100  #: per cent of a candidate's occurrences that lie in one longer candidate, for it to be dropped
SENT = 4_000_000  #: keys broadcast at a time
HELD = 2_000_000  #: pairs that a task sums before it passes them on
BATCH_ROWS = 512
BREAK = b"\n"
#: What ends a piece, and the tab, which parts words as a space does.
TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")


def tokens(text: str | None) -> list[bytes]:
    """Words with BREAK between pieces; empty strings among them stand for spaces alone."""
    return (text or "").encode().lower().translate(TABLE).replace(BREAK, b" \n ").split(b" ")  # of bytes, lower() takes A-Z alone


def interned(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct tokens, their places in it for all tokens, number of tokens of each text); without empty ones, with BREAK after each text."""
    each = [[*tokens(t), BREAK] for t in texts]
    found = pa.array([w for t in each for w in t], pa.binary()).dictionary_encode()
    words, at = found.dictionary.to_pylist(), found.indices.to_numpy()
    owner = np.repeat(np.arange(len(each)), [len(t) for t in each])
    if b"" in words:
        real = at != words.index(b"")
        at, owner = at[real], owner[real]
    return words, at, np.bincount(owner, minlength=len(each))


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str | None]]]:
    langs, texts = (batch.column(i).to_pylist() for i in range(2))
    groups: dict[str, list[str | None]] = {}
    for lang, text in zip(langs, texts, strict=True):
        groups.setdefault(lang, []).append(text)
    yield from groups.items()


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text); a null word has the language's number of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in by_lang(batch):
                words, at, _ = interned(texts)
                n = np.bincount(at, minlength=len(words))
                real = [i for i, w in enumerate(words) if n[i] and w != BREAK]
                out = [words[i].decode() for i in real]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(out) + 1), pa.string()), pa.array([*out, None], pa.string()), pa.array([*n[real].tolist(), int(n[real].sum())], pa.int64())], names=["lang", "word", "n"])

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """df, written, with number: 0, 1, 2 ... without a gap; and how many rows there are."""
    made = settle(df.withColumn("number", F.monotonically_increasing_id()), name)
    part = F.shiftright("number", 33)
    sizes = made.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each task that wrote
    bases = sizes.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_base"), "n")
    total = bases.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = made.join(F.broadcast(bases.drop("n")), part == F.col("_part")).withColumn("number", (F.col("_base") + F.col("number").bitwiseAND(F.lit((1 << 33) - 1))))
    return out.drop("_part", "_base"), total


def parts(level: DataFrame, total: int) -> Iterator[DataFrame]:
    """The level's rows, SENT at most at a time."""
    n = -(-total // SENT)
    for k in range(n):
        yield level if n == 1 else level.filter(F.pmod("number", F.lit(n)) == k)


def first_places(rows: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(at array<int>) of each text: the numbers of its frequent words, -1 for others and between pieces."""
    spark = rows.sparkSession
    out = rows.withColumn("at", F.lit(None).cast("array<int>"))
    for k, part in enumerate(parts(words, total)):
        known: dict[str, dict[bytes, int]] = {}
        for r in part.select("lang", "phrase", "number").toLocalIterator():
            known.setdefault(r.lang, {})[r.phrase.encode()] = r.number
        sent = spark.sparkContext.broadcast(known)

        def fill(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                before = dict(zip(batch.column(0).to_pylist(), [None] * batch.num_rows, strict=True))
                langs, texts, had = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
                for lang in before:
                    mine = [i for i, x in enumerate(langs) if x == lang]
                    chosen = [texts[i] for i in mine]
                    found, at, sizes = interned(chosen)
                    number = sent.value.get(lang, {})
                    ids = np.array([number.get(w, -1) for w in found], np.int32)[at]
                    old = had.take(pa.array(mine))
                    if old.null_count < len(mine):
                        ids = np.where(ids < 0, old.flatten().to_numpy(), ids)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(mine), pa.string()), pa.array(chosen, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=["lang", "text", "at"])

        filled = out.mapInArrow(fill, "lang string, text string, at array<int>")
        last = (k + 1) * SENT >= total
        with batches_of(spark, BATCH_ROWS):
            out = settle(filled.select("at") if last else filled, "places")
    return out.select("at")


def pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places where a pair of frequent neighbours begins, their keys, all places' owner) of a batch of places."""
    column = batch.column(0)
    at = column.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    begin = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & (owner[:-1] == owner[1:]))
    return begin, at[begin] << 32 | at[begin + 1], owner


def pair_counts(places: DataFrame) -> DataFrame:
    """(key, n) of all pairs of frequent neighbours; a key is the first's number and the second's, 32 bits each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        def passed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

        size = 0
        for batch in batches:
            held.append(np.unique(pairs(batch)[1], return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                held = [summed()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield passed(*held[0])
                    held, size = [], 0
        if held:
            yield passed(*summed())

    return places.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def next_places(places: DataFrame, level: DataFrame, total: int) -> DataFrame:
    """Places of one level to those of the next; texts without any are left out."""
    spark = places.sparkSession
    out = places.withColumn("new", F.lit(None).cast("array<int>"))
    for k, part in enumerate(parts(level, total)):
        found = np.array([(r.key, r.number) for r in part.select("key", "number").toLocalIterator()], np.int64).reshape(-1, 2)
        found = found[np.argsort(found[:, 0])]
        sent = spark.sparkContext.broadcast((found[:, 0].copy(), found[:, 1].astype(np.int32)))

        def fill(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            keys, numbers = sent.value
            for batch in batches:
                begin, key, owner = pairs(batch)
                column, had = batch.column(0), batch.column(1)
                new = np.full(len(owner), -1, np.int32) if had.null_count else had.flatten().to_numpy().copy()
                near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[near] == key
                new[begin[hit]] = numbers[near[hit]]
                offsets = pa.array(column.offsets.to_numpy() - column.offsets[0].as_py(), pa.int32())
                yield pa.RecordBatch.from_arrays([column, pa.ListArray.from_arrays(offsets, pa.array(new, pa.int32()))], names=["at", "new"])

        filled = out.mapInArrow(fill, "at array<int>, new array<int>")
        last = (k + 1) * SENT >= total
        with batches_of(spark, BATCH_ROWS):
            out = settle(filled.select(F.col("new").alias("at")).filter(F.array_max("at") >= 0) if last else filled, "places")
    return out.select("at")


def levels(docs: DataFrame, least: int, most_words: int) -> tuple[list[DataFrame], DataFrame]:
    """Level tables (lang, phrase, last, a, firsts, lasts, pre, suf, number) for 1 to most_words words, and (lang, n).

    firsts and lasts: counts of the first and last 1, 2, ... words, itself left out; pre, suf: numbers of its parts in the level before.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    with batches_of(spark, BATCH_ROWS):
        counts = settle(word_counts(rows).filter((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = counts.filter(F.col("word").isNull()).select("lang", "n")
    none = F.array().cast("array<long>")
    words = counts.filter(F.col("word").isNotNull()).select("lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("n").alias("a"), none.alias("firsts"), none.alias("lasts"))
    level, total = numbered(words, "level-1")
    out = [level.withColumns({"pre": F.lit(None).cast("long"), "suf": F.lit(None).cast("long")})]
    places = None
    for k in range(2, most_words + 1):
        if not total:
            break
        places = first_places(rows, level, total) if places is None else next_places(places, level, total)
        with batches_of(spark, BATCH_ROWS):
            found, total = numbered(pair_counts(places).filter(F.col("n") >= least), f"pairs-{k}")
        pre, suf = F.shiftrightunsigned("key", 32), F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
        before = level.select("lang", "phrase", "last", "a", "firsts", "lasts", "number")
        p = before.select("lang", "phrase", F.concat("firsts", F.array("a")).alias("firsts"), F.col("number").alias("pre"))
        s = before.select("last", F.concat("lasts", F.array("a")).alias("lasts"), F.col("number").alias("suf"))
        joined = found.select("key", "number", F.col("n").alias("a"), pre.alias("pre"), suf.alias("suf")).join(p, "pre").join(s, "suf")
        level = joined.select("key", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a", "firsts", "lasts", "pre", "suf", "number")
        level = settle(level, f"level-{k}")
        out.append(level.drop("key"))
    return out, totals


def mine_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, first: int = FIRST, share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first phrases, by score.

    least >= 1, most_words >= 2. A phrase is left out if a longer candidate holds share per cent of its occurrences; as counts fall with length, candidates of one more word tell.
    """
    tables, totals = levels(docs, least, most_words)
    spark = docs.sparkSession
    out = spark.createDataFrame([], "lang string, phrase string, a long, firsts array<long>, lasts array<long>")
    for k, level in enumerate(tables[1:], 1):
        if k + 1 < len(tables):
            longer = tables[k + 1]
            within = longer.select(F.col("pre").alias("number"), F.col("a").alias("b")).unionByName(longer.select(F.col("suf").alias("number"), F.col("a").alias("b"))).groupBy("number").agg(F.max("b").alias("b"))
            level = level.join(within, "number", "left").filter(F.col("b").isNull() | (100 * F.col("b").cast("decimal(20,0)") < share * F.col("a").cast("decimal(20,0)")))
        out = out.unionByName(level.select("lang", "phrase", "a", "firsts", "lasts"))
    # l * r < 10^38 and 1000 * a * n < 10^38 for up to 10^17 words
    cuts = F.transform(F.sequence(F.lit(1), F.size("firsts")), lambda k: F.struct(k.alias("k"), F.get("firsts", k - 1).alias("l"), F.get("lasts", F.size("firsts") - k).alias("r")))
    scored = out.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select("lang", "phrase", "a", "n", F.explode(cuts).alias("cut"))
    score = F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)) div (CAST(cut.l AS DECIMAL(19,0)) * CAST(cut.r AS DECIMAL(19,0)))")
    scored = scored.withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut.k", "cut.l", "cut.r")).alias("b"))
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
