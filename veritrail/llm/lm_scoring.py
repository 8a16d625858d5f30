"""Language-model scores of texts: a trigram model by deleted interpolation.

    P(w | uv) = k[1] c(uvw) / c(uv) + k[2] c(vw) / c(v) + k[3] c(w) / N + k[4] / (V + 1)

with c the counts in training documents and k the weights of a bucket: that of c(uv) by powers of two, or if u v was never seen, of c(v). For each
bucket they are learned by expectation-maximisation on held-out
counts: one training document in TUNED is set apart for that, and its tokens are predicted from the counts of the others. Scores use the counts of all
training documents. A text's first token has the mark before texts as its only context.

Counts are exact and cover all training documents; words, pairs and triples are known by 64-bit hashes. Texts are
cut into units of some MB. A unit asks for the counts of its distinct words, then of its distinct pairs, then of its triples, as packed
sorted arrays, one for each hash range; a task adds up the arrays of a range and answers in their order. So a pair
that is frequent is one entry of each unit, and nothing is kept by all. Pairs of a word that no other unit has, and triples of a pair
that no other unit has, are counted at home. A row of questions holds one entry at least, and short arrays are not compressed, so rows and bytes are
never more than in proportion to the entries. Units are written once, bucketed, and stay where they are; only questions and answers move.

The statistics for the weights come from the units, each for its own held-out tokens, with counts of all. They are summed in cells of like probabilities, each with its mean
probabilities, so only the spread within a cell (a quarter of a power of two each way) is lost to them.

Edge cases: a null or empty text, or one of white space, is its end token alone. A null id counts as remainder 0
(training). Without training documents N and V are 0, all scores come from 1 / (V + 1). Rows with the same id are
documents of their own. Further columns are ignored. An empty table gives an empty table. Long texts may fill
a unit of their own.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.anchors import mix
from veritrail.llm.common import batches_of, new_path, settle, small_batches

HELD_OUT, FOLDS = 2, 7
TUNED = 8  #: of so many training documents one is held out for the mixture weights
SHORT = 256  #: bytes of an array that is not compressed
UNIT_BYTES = 8 << 20  #: text of a unit; the last document may pass it
JOIN_BYTES = 1 << 20  #: text tokenised at a time
RANGE_ENTRIES = 1 << 20  #: entries that a task adds up at a time, on average
LEVELS = 32  #: of counts; as many buckets for contexts of two words as for those of one
STEPS = 2  #: of a power of two, in the statistics for the mixture weights
CELLS = 50  #: probabilities down to 2 ** -24, and zero
ROUNDS = 50

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
START, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)  #: hashes of the marks

UNITS = "unit long, doc_ids array<long>, held array<boolean>, tunes array<boolean>, sizes array<int>, n_words int, words binary, trained binary, tuned binary, tokens binary"
ASKED = "span int, unit long, n int, hashes binary, counts binary, tuned binary"
ANSWER = "span int, unit long, counts binary, tuned binary, alone binary"
STATISTIC = "cell long, weight double, p3 double, p2 double, p1 double"
TOTALS = "seen long, tokens long, tuned long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Words:
    """Hashes of lower-cased words, for many texts at once."""

    def __init__(self) -> None:
        table = np.random.default_rng(10).integers(1, 1 << 64, 256, dtype=np.uint64)
        table[65:91] = table[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        table[self.space] = 0
        self.table = table
        self.up = np.ones(1, np.uint64)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, number of words of each text)."""
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = self.space[raw]
        starts = np.flatnonzero(~space & np.append(True, space[:-1]))
        ends = np.cumsum([len(t) + 1 for t in texts])
        counts = np.diff(np.searchsorted(starts, ends), prepend=0)
        if not len(starts):
            return np.zeros(0, np.uint64), counts
        at = np.zeros(len(raw), np.int64)
        at[starts] = starts
        off = np.arange(len(raw)) - np.maximum.accumulate(at)
        off[space] = 0
        if off.max() >= len(self.up):
            up = np.full(int(off.max()) + 1, MULTIPLIER, np.uint64)
            up[0] = 1
            self.up = np.multiply.accumulate(up)
        sums = np.add.reduceat(self.table[raw] * self.up[off], starts)
        sizes = np.add.reduceat((~space).astype(np.uint64), starts)
        return mix(sums + sizes * MULTIPLIER), counts


def pack_ints(x: np.ndarray) -> bytes:
    """Byte planes, compressed unless short; the first byte says which."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return b"\0" + raw if len(raw) <= SHORT else b"\1" + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_ints(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]) if data[0] else data[1:], np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack_ints(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data, np.uint64), dtype=np.uint64)


def columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<int>": pa.list_(pa.int32())}
    fields = [f.split() for f in schema.split(", ")]
    data = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(data, fields, strict=True)], names=[n for n, _ in fields])


def make_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held, tunes, text) -> UNITS."""
    from pyspark import TaskContext

    words, base = Words(), TaskContext.get().partitionId() << 32
    ids: list = []
    held: list[bool] = []
    tunes: list[bool] = []
    parts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    seq, size, total = 0, 0, 0
    texts: list[bytes] = []

    def tokenise() -> None:
        hashes, counts = words.of(texts)
        stops = np.cumsum(counts)
        parts.append(np.insert(hashes, stops, END))
        sizes.append(counts + 1)
        texts.clear()

    def close() -> pa.RecordBatch:
        all_hashes, n = np.concatenate(parts), np.concatenate(sizes)
        uniq, local = np.unique(all_hashes, return_inverse=True)
        train = np.repeat(~np.array(held, bool), n)
        trained, tuned = (np.bincount(local[of], minlength=len(uniq)).astype(np.uint32) for of in (train, np.repeat(np.array(tunes, bool), n)))
        return columns([(base | seq, ids, held, tunes, n.tolist(), len(uniq), pack_sorted(uniq), pack_ints(trained), pack_ints(tuned), pack_ints(local.astype(np.uint32)))], UNITS)

    for batch in batches:
        for doc_id, out, tune, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            ids.append(doc_id)
            held.append(out)
            tunes.append(tune)
            texts.append(data)
            size += len(data)
            total += len(data)
            if size >= JOIN_BYTES:
                tokenise()
                size = 0
            if total >= UNIT_BYTES:
                if texts:
                    tokenise()
                yield close()
                seq, size, total, ids, held, tunes, parts, sizes = seq + 1, 0, 0, [], [], [], [], []
    if ids:
        if texts:
            tokenise()
        yield close()


def spans(hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of a sorted array's non-empty hash ranges."""
    if not bits:
        return [(0, 0, len(hashes))] if len(hashes) else []
    own = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(own, prepend=-1, append=-1))
    return [(int(own[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def questions(unit: int, bits: int, hashes: np.ndarray, counts: np.ndarray, tuned: np.ndarray) -> pa.RecordBatch:
    """ASKED of a unit's sorted hashes: a row for each range."""
    return columns([(s, unit, b - a, pack_sorted(hashes[a:b]), pack_ints(counts[a:b]), pack_ints(tuned[a:b])) for s, a, b in spans(hashes, bits)], ASKED)


def ask_words(bits: int):  # noqa: ANN201
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, words, trained, tuned in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield questions(unit, bits, unpack_sorted(words), unpack_ints(trained, np.uint32), unpack_ints(tuned, np.uint32))

    return run


def by_span(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ASKED sorted by span -> ANSWER: of each entry the counts of all units, and whether no other unit asked."""
    for rows in by_span(batches):
        hashes = np.concatenate([unpack_sorted(r[3]) for r in rows])
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        asking = np.diff(np.append(first, len(hashes)))
        out = []
        for k in (4, 5):
            counts = np.concatenate([unpack_ints(r[k], np.uint32) for r in rows]).astype(np.int64)
            of = np.empty(len(hashes), np.uint32)
            of[order] = np.repeat(np.add.reduceat(counts[order], first), asking)
            out.append(of)
        alone = np.empty(len(hashes), np.uint8)
        alone[order] = np.repeat(asking == 1, asking)
        at = 0
        for r in rows:
            own = slice(at, at + r[2])
            yield columns([(r[0], r[1], pack_ints(out[0][own]), pack_ints(out[1][own]), pack_ints(alone[own]))], ANSWER)
            at += r[2]


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ASKED sorted by span -> TOTALS of the distinct entries."""
    for rows in by_span(batches):
        hashes = np.concatenate([unpack_sorted(r[3]) for r in rows])
        counts, tuned = (np.concatenate([unpack_ints(r[k], np.uint32) for r in rows]).astype(np.int64) for k in (4, 5))
        yield columns([(len(np.unique(hashes[counts > 0])), int(counts.sum()), int(tuned.sum()))], TOTALS)


def level(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(c + 1.0)[1] - 1, LEVELS - 1)


def bucket(cuv: np.ndarray, cv: np.ndarray) -> np.ndarray:
    return np.where(cuv > 0, level(cuv), LEVELS + level(cv))


def cell_of(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(1 + np.round(-STEPS * np.log2(p)), 1, CELLS - 1), 0).astype(np.int64)


def statistics(times: np.ndarray, buckets: np.ndarray, parts: list[np.ndarray]) -> pa.RecordBatch:
    """STATISTIC of n-grams held out, each as often as times says: their buckets, and the probabilities of triple, pair and word."""
    cells = buckets.astype(np.int64)
    for p in parts:
        cells = cells * CELLS + cell_of(p)
    found, own = np.unique(cells, return_inverse=True)
    sums = [np.bincount(own, x, len(found)).tolist() for x in (times, *(times * p for p in parts))]
    return columns(list(zip(found.tolist(), *sums, strict=True)), STATISTIC)


def mixture(stats: list[tuple], vocabulary: int) -> np.ndarray:
    """(2 * LEVELS, 4) weights of triple, pair, word and uniform probabilities."""
    out = np.tile([0.0, 0.0, 0.9, 0.1], (2 * LEVELS, 1))
    if not stats:
        return out
    cell, weight, *parts = (np.array(c) for c in zip(*stats, strict=True))
    p = np.stack([*(x / weight for x in parts), np.full(len(cell), 1 / (vocabulary + 1))], axis=1)
    of = cell // CELLS**3
    for b in np.unique(of):
        q, times = p[of == b], weight[of == b]
        w = np.full(4, 1 / 4)
        for _ in range(ROUNDS):
            share = q * w
            w = (times[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / times.sum()
        w = np.maximum(w, [0, 0, 1e-9, 1e-9])  # no text gets probability zero
        out[b] = w / w.sum()
    return out


class Facts(NamedTuple):
    """Totals of training documents, and of those among them that aren't held out for the weights."""

    tokens: int
    vocabulary: int
    documents: int
    fitted_tokens: int
    fitted_documents: int


class Unit:
    """A unit with its words' counts, its pairs and triples, and the counts of these where they are answered."""

    def __init__(self, row: dict, facts: Facts):
        self.row, self.facts = row, facts
        self.words = unpack_sorted(row["words"])
        self.tokens = unpack_ints(row["tokens"], np.uint32).astype(np.int64)
        self.sizes, self.held = np.array(row["sizes"], np.int64), np.array(row["held"], bool)
        self.cw, self.fw, self.word_alone = answers_of(row["word_answers"])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train, self.tune = (np.repeat(of, self.sizes) for of in (~self.held, np.array(row["tunes"], bool)))
        n = len(self.words)
        previous = np.append(n, self.tokens[:-1])  # n: the mark before each text
        previous[self.starts] = n
        self.own, pair = told_apart(previous * (n + 1) + self.tokens)
        self.v, self.w = pair // (n + 1), pair % (n + 1)
        self.count, self.tuned = self.counted(self.own, len(pair))
        alone = np.append(self.word_alone, False)
        self.pair_home = alone[self.v] | alone[self.w]
        self.cv, self.fv = np.append(self.cw, facts.documents)[self.v], np.append(self.fw, facts.fitted_documents)[self.v]

    def counted(self, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.bincount(own[of], minlength=n).astype(np.uint32) for of in (self.train, self.tune))

    def pair_hashes(self) -> np.ndarray:
        words = np.append(self.words, START)
        return mix(words[self.v] * MULTIPLIER ^ mix(words[self.w] + MULTIPLIER))

    def answer_pairs(self) -> None:
        """c(vw) of all documents and without those held out, and triples: each by the pair before a token's and its own."""
        self.cvw, self.fvw, self.pair_alone = filled(self.count, self.tuned, self.pair_home, self.pair_hashes, self.row["pair_answers"])
        n = len(self.v)
        before = np.append(n, self.own[:-1])  # n: none
        before[self.starts] = n
        self.own3, triple = told_apart(before * n + self.own)
        self.before, self.pair = np.divmod(triple, n)
        self.count3, self.tuned3 = self.counted(self.own3, len(triple))
        alone = np.append(self.pair_alone, True)
        self.first = self.before == n
        self.home3 = alone[self.before] | alone[self.pair]
        self.cuv, self.fuv = np.append(self.cvw, 0)[self.before], np.append(self.fvw, 0)[self.before]

    def triple_hashes(self) -> np.ndarray:
        h = np.append(self.pair_hashes(), START)
        return mix(h[self.before] * MULTIPLIER ^ mix(h[self.pair] + MULTIPLIER))

    def answer_triples(self) -> None:
        self.cuvw, self.fuvw, _ = filled(self.count3, self.tuned3, self.home3, self.triple_hashes, self.row["triple_answers"])

    def ask(self, bits: int, hashes: np.ndarray, home: np.ndarray, count: np.ndarray, tuned: np.ndarray) -> pa.RecordBatch:
        use = in_order(hashes, home)
        return questions(self.row["unit"], bits, hashes[use], count[use], tuned[use])

    def parts(self, fitted: bool, use: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of the triples in use: buckets, and probabilities of triple, pair and word; fitted: without what is held out for the weights."""
        pair = self.pair[use]
        cuv, cuvw, cvw, cv, cw, n = (self.fuv, self.fuvw, self.fvw, self.fv, self.fw, self.facts.fitted_tokens) if fitted else (self.cuv, self.cuvw, self.cvw, self.cv, self.cw, self.facts.tokens)
        cuv, v = cuv[use], cv[pair]
        return bucket(cuv, v), [cuvw[use] * (cuv > 0) / np.maximum(cuv, 1), cvw[pair] / np.maximum(v, 1), cw[self.w[pair]] / max(n, 1)]


def told_apart(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, values): values and places are sorted as one integer, which is faster than sorting places by values."""
    bits = len(x).bit_length()
    if int(x.max(initial=0)).bit_length() + bits > 63:
        values, own = np.unique(x, return_inverse=True)
        return own, values
    both = np.sort(x << bits | np.arange(len(x)))
    values, place = both >> bits, both & ((1 << bits) - 1)
    new = np.append(True, values[1:] != values[:-1])
    own = np.empty(len(x), np.int64)
    own[place] = np.cumsum(new) - 1
    return own, values[new]


def in_order(hashes: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Entries that aren't counted at home, by the leading bits of their hashes; as many as their number leaves of 64."""
    mask = np.uint64((1 << len(hashes).bit_length()) - 1)
    both = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    return (np.sort(both[~home]) & mask).astype(np.int64)


def filled(count: np.ndarray, tuned: np.ndarray, home: np.ndarray, hashes, answers: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
    """Counts of all, counts without what is held out for the weights, and whether no other unit has the entry: a unit's own counts, or the answers."""
    c, f, alone = count.astype(np.int64), count.astype(np.int64) - tuned, home.copy()
    if not home.all():
        use = in_order(hashes(), home)
        c[use], f[use], alone[use] = answers_of(answers)
    return c, f, alone


def answers_of(answers: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, counts without those held out for the weights, alone."""
    counts, tuned = joined(answers), joined(answers, "tuned")
    return counts, counts - tuned, joined(answers, "alone", np.uint8).astype(bool)


def joined(answers: list, what: str = "counts", kind: type = np.uint32) -> np.ndarray:
    parts = [unpack_ints(a[what], kind) for a in sorted(answers or [], key=lambda a: a["span"])]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def each_unit(facts: Facts, of) -> object:  # noqa: ANN001
    """A mapInArrow function: of(unit) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield of(Unit(row, facts))

    return run


def ask_pairs(bits: int):  # noqa: ANN201
    return lambda u: u.ask(bits, u.pair_hashes(), u.pair_home, u.count, u.tuned)


def ask_triples(bits: int):  # noqa: ANN201
    def of(u: Unit) -> pa.RecordBatch:
        u.answer_pairs()
        return u.ask(bits, u.triple_hashes(), u.home3, u.count3, u.tuned3)

    return of


def held_out_statistics(u: Unit) -> pa.RecordBatch:
    u.answer_pairs()
    u.answer_triples()
    use = np.flatnonzero(u.tuned3)
    return statistics(u.tuned3[use].astype(np.float64), *u.parts(True, use))


def score(weights: np.ndarray):  # noqa: ANN201
    def of(u: Unit) -> pa.RecordBatch:
        u.answer_pairs()
        u.answer_triples()
        buckets, parts = u.parts(False)
        p = weights[buckets, 3] / (u.facts.vocabulary + 1)
        for k, part in enumerate(parts):
            p += weights[buckets, k] * part
        base = np.log10((u.cw + 1) / (u.facts.tokens + 1 * (u.facts.vocabulary + 1)))[u.tokens]
        add = lambda x: np.add.reduceat(x, u.starts).tolist()
        known = add((u.cw > 0)[u.tokens].astype(np.int64))
        return columns(list(zip(u.row["doc_ids"], u.row["held"], u.sizes.tolist(), known, [u.facts.tokens] * len(u.sizes), add(base), add(np.log10(p)[u.own3]), strict=True)), SCORED)

    return of


def answered(asked: DataFrame, name: str) -> DataFrame:
    """(unit, name): a unit's answers, written."""
    got = asked.repartition("span").sortWithinPartitions("span").mapInArrow(add_up, ANSWER)
    return settle(got.groupBy("unit").agg(F.collect_list(F.struct("span", "counts", "tuned", "alone")).alias(name)), f"lm-{name}")


def collected(units: DataFrame, facts: Facts) -> list[tuple]:
    """Held-out statistics of all units, summed by cell: at most 2 * LEVELS x CELLS ** 3 rows reach the driver, and no more than there are kinds of counts."""
    sums = units.mapInArrow(each_unit(facts, held_out_statistics), STATISTIC).groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("weight", "p3", "p2", "p1")])
    return [tuple(r) for r in sums.orderBy("cell").collect()]


def range_bits(entries: int) -> int:
    return max(3, math.ceil(math.log2(max(entries, 1) / RANGE_ENTRIES))) if entries else 3


def lm_scores(docs: DataFrame) -> DataFrame:
    """SCORED for every document."""
    spark = docs.sparkSession
    small_batches(spark)
    text_id = F.col("doc_id").cast("string")
    code = F.coalesce(F.crc32(text_id.cast("binary")), F.lit(0))
    held = F.pmod(code, F.lit(FOLDS)) == HELD_OUT
    tunes = ~held & (F.pmod(F.floor(code / FOLDS), F.lit(TUNED)) == 0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), tunes.alias("tunes"), "text")
    name = f"lm_units_{uuid.uuid4().hex}"
    made = rows.mapInArrow(make_units, UNITS)
    buckets = max(1, min(rows.rdd.getNumPartitions(), 100_000))
    made.write.bucketBy(buckets, "unit").format("parquet").option("path", new_path(spark, "lm-units")).option("compression", "none").saveAsTable(name)
    try:
        with batches_of(spark, 1):  # a unit is some MB
            return scored(spark.table(name))
    finally:
        spark.sql(f"DROP TABLE {name}")  # its name alone: the files are in the shared folder


def scored(units: DataFrame) -> DataFrame:
    """SCORED for every document of the units, written: all joins find units where they are, by their buckets."""
    count = lambda of: F.sum(F.size(of))
    sizes = units.agg(F.sum("n_words").alias("n"), count(F.filter("held", lambda h: ~h)).alias("docs"), count(F.filter("tunes", lambda t: t)).alias("tuned"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).alias("tokens")).first()
    asked = units.select("unit", "words", "trained", "tuned").mapInArrow(ask_words(range_bits(sizes.n or 0)), ASKED)
    words = answered(asked, "word_answers")
    sums = asked.repartition("span").sortWithinPartitions("span").mapInArrow(totals, TOTALS).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("seen", "tokens", "tuned")]).first()
    documents = sizes.docs or 0
    facts = Facts(sums.tokens, sums.seen, documents, sums.tokens - sums.tuned, documents - (sizes.tuned or 0))
    bits = range_bits(sizes.tokens or 0)
    known = units.join(words.hint("shuffle_hash"), "unit")
    pairs = answered(known.mapInArrow(each_unit(facts, ask_pairs(bits)), ASKED), "pair_answers")
    known = known.join(pairs.hint("shuffle_hash"), "unit", "left")
    triples = answered(known.mapInArrow(each_unit(facts, ask_triples(bits)), ASKED), "triple_answers")
    known = known.join(triples.hint("shuffle_hash"), "unit", "left")
    weights = mixture(collected(known, facts), facts.vocabulary)
    return settle(known.mapInArrow(each_unit(facts, score(weights)), SCORED), "lm-scores")
