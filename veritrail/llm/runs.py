"""Periodic runs of words: Main-Lorentz divide and conquer over interned word ids.

A run is a stretch of consecutive words with smallest period q, at least LEAST words and twice its period long, that no word next to it extends with
period q. Each text is halved again and again; at each midpoint the Z-values of all positions of its segment are found (how far the text at a position
goes on as the text at the midpoint does, forwards and backwards). Where the two together reach the distance, a repetition crosses the midpoint; as
Z-values reach beyond the segment, it is maximal at once. The same interval is found with multiples of its period and at several midpoints; the
smallest period is kept. Segments of fewer than LEAST words hold no run, so halving ends there.

Numpy takes one level of all texts of a batch at a time. Z-values of most positions are 0 and those of most others end within LEAST words; the rest
are found exactly by names of blocks of doubling length (equal names, equal blocks), so a text of one repeated word takes n log n steps too.

Edge cases: a null or empty text, or one of white space alone, has no words, no runs and the empty collapsed text. Repeated rows each get their own
result. Further columns of documents are kept; columns named runs, n_words or collapsed are replaced. Texts of any length are taken whole: one text's
words are in one task, some 200 bytes each where long repetitions occur, and texts are put together up to GROUP_WORDS words at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import WORD, batches_of, settle

LEAST = 12  #: words of a run
GROUP_WORDS = 1 << 20
BATCH_ROWS = 256
RUNS = "array<struct<start:long,length:long,period:long>>"


class Names:
    """Names of the blocks of 2^k words from each position, for as many k as are asked for."""

    def __init__(self, ids: np.ndarray):
        self.levels = [ids]

    def at(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            both = last[:-half].astype(np.int64) << 32 | last[half:]
            self.levels.append(np.unique(both, return_inverse=True)[1].astype(np.int32))
        return self.levels[k]

    def forwards(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from x and from y on, pair by pair."""
        return self.reach(x, y, 1)

    def backwards(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words before x and before y."""
        return self.reach(x, y, -1)

    def reach(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        n = len(self.levels[0])
        out = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        k = 0

        def same(which: np.ndarray, k: int) -> np.ndarray:
            """Whether the next 2^k words of these pairs are equal."""
            size = 1 << k
            a, b = (z[which] + out[which] if way > 0 else z[which] - out[which] - size for z in (x, y))
            inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) + size <= n)
            equal = np.zeros(len(which), bool)
            names = self.at(k) if inside.any() else None
            if names is not None:
                equal[inside] = names[a[inside]] == names[b[inside]]
            return equal

        while len(live) and 1 << k <= n:  # longer and longer blocks while they are equal
            live = live[same(live, k)]
            out[live] += 1 << k
            k += 1
        rest = np.arange(len(x))
        for j in range(min(k, len(self.levels) - 1), -1, -1):  # then the remainder, from long to short
            ok = rest[same(rest, j)]
            out[ok] += 1 << j
        return out


def crossing(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, period) of what repeats across midpoints; texts lie at starts, each followed by an id that occurs once."""
    own = np.zeros(len(starts), bool)
    for _, mid, _ in candidates(ids, starts, sizes):
        own[np.searchsorted(starts, mid, "right") - 1] = True
    own = np.flatnonzero(own)  # names of blocks are made for the texts of candidates alone
    size = sizes[own] + 1
    begin = np.cumsum(size) - size
    names = Names(ids[np.arange(size.sum()) + np.repeat(starts[own] - begin, size)])
    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    for at, mid, need in candidates(names.levels[0], begin, sizes[own]):
        right, left = names.forwards(at, mid), names.backwards(at, mid)
        ok = right + left >= need
        at, mid, right, left = at[ok], mid[ok], right[ok], left[ok]
        found.append(smallest(np.minimum(at, mid) - left, np.maximum(at, mid) + right, np.abs(at - mid)))
    begins, ends, periods = smallest(*(np.concatenate(x) for x in zip(*found, strict=True)))
    shift = (starts[own] - begin)[np.searchsorted(begin, begins, "right") - 1] if len(begins) else none
    return begins + shift, ends + shift, periods


def smallest(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each interval once, with its smallest period."""
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.flatnonzero((np.diff(begin, prepend=-1) != 0) | (np.diff(end, prepend=-1) != 0))
    return begin[first], end[first], period[first]


def candidates(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(position, midpoint, equal words that a run has around them), level by level, of all that the nearest words don't rule out."""
    half = 1 << (LEAST - 1).bit_length() - 1  # the shortest segments that hold a run
    while half < sizes.max(initial=0):
        mids, lows, highs = segments(starts, sizes, half)
        span = highs - lows
        at = np.arange(span.sum()) + np.repeat(lows - np.cumsum(span) + span, span)  # each position of each segment
        mid = np.repeat(mids, span)
        here = np.flatnonzero(((ids[at] == np.repeat(ids[mids], span)) | (ids[at - 1] == np.repeat(ids[mids - 1], span))) & (at != mid))
        at, mid = at[here], mid[here]
        need = np.maximum(np.abs(at - mid), LEAST - np.abs(at - mid))
        left = near(ids, at, mid, need)
        yield at[left], mid[left], need[left]
        half *= 2


def segments(starts: np.ndarray, sizes: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(midpoint, first, end) of the segments of 2 half words of all texts that reach their midpoint."""
    each = (sizes + half - 1) // (2 * half)  # whose midpoint has a word
    text = np.repeat(np.arange(len(sizes)), each)
    k = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    low = starts[text] + k * 2 * half
    return low + half, low, np.minimum(low + 2 * half, starts[text] + sizes[text])


def near(ids: np.ndarray, at: np.ndarray, mid: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Places of the pairs that are left after looking at the nearest words."""
    few = LEAST // 2  # equal words, before and after together, that any run has at a midpoint
    n = len(ids)
    ahead, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    for step in range(few):
        x, y = at[live] + step, mid[live] + step
        ok = np.maximum(x, y) < n
        live = live[ok][ids[x[ok]] == ids[y[ok]]]
        ahead[live] += 1
    live = np.arange(len(at))
    for step in range(1, few + 1):
        x, y = at[live] - step, mid[live] - step
        ok = np.minimum(x, y) >= 0
        live = live[ok][ids[x[ok]] == ids[y[ok]]]
        back[live] += 1
    return np.flatnonzero((ahead + back >= few) & ((ahead == few) | (back == few) | (ahead + back >= need)))


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each text's words an array of (start, length, period), by start and then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return [np.zeros((0, 3), np.int64) for _ in texts]
    interned = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int32)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(int(sizes.sum()) + len(texts), np.int32)
    ends = starts + sizes
    is_word = np.ones(len(ids), bool)
    is_word[ends] = False
    ids[is_word] = interned
    ids[ends] = np.arange(len(texts)) + len(interned)  # once each, so that nothing crosses
    begin, end, period = crossing(ids, starts, sizes)
    text = np.searchsorted(starts, begin, "right") - 1
    rows = np.stack([begin - starts[text], end - begin, period], 1)
    order = np.lexsort((period, begin))
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    return [rows[order[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs.tolist():
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def grouped(words: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    group: list[list[bytes]] = []
    size = 0
    for w in words:
        if group and size + len(w) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(w)
        size += len(w)
    if group:
        yield group


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, runs (start and period in words, numbered from 0) and collapsed: the words outside repeats, joined by single spaces."""
    docs = docs.drop("n_words", "runs", "collapsed")
    names = [f"c{i}" for i in range(len(docs.columns))]  # whatever is in the documents' own
    columns = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True)]
    given = docs.select("*", F.col(text)).toDF(*names, "source")
    names += ["n_words", "runs", "collapsed"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            done = 0
            for group in grouped([(t or "").encode().split() for t in texts]):  # on just the six characters that part words
                results = runs_of(group)
                counts = np.array([len(r) for r in results])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                flat = np.concatenate(results)
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type)))
                left = [b" ".join(w if not len(r) else [x for x, k in zip(w, kept(len(w), r).tolist(), strict=True) if k]).decode() for w, r in zip(group, results, strict=True)]
                own = batch.slice(done, len(group)).columns[:-1]
                done += len(group)
                yield pa.RecordBatch.from_arrays([*own, pa.array([len(w) for w in group], pa.int64()), lists, pa.array(left, pa.string())], names=names)

    spark = docs.sparkSession
    with batches_of(spark, BATCH_ROWS):
        done = given.mapInArrow(find, ", ".join([*columns, "n_words long", f"runs {RUNS}", "collapsed string"]))
        return settle(done.toDF(*docs.columns, "n_words", "runs", "collapsed"), "runs")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with single spaces; a tenth of the documents repeat a stretch of their own words up to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    df = docs.select("doc_id", words.alias("w"), F.coalesce(h, F.lit(1)).alias("h"))
    df = df.withColumns({"n": n, "a": F.when(n > 0, F.pmod(g, n)).cast("int"), "g": g})
    df = df.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    cycle = F.transform(F.sequence(F.lit(0), (F.col("n") - F.col("a") - 1).cast("int")), lambda i: F.get("w", F.col("a") + i % F.col("p")))
    changed = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return df.select("doc_id", F.array_join(F.when(changed, F.concat(F.slice("w", F.lit(1), F.col("a")), cycle)).otherwise(F.col("w")), " ").alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256), the four of the longest run."""
    done = find_runs(planted(docs))
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.when(x["length"] > y["length"], -1).otherwise(1))
        .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).when(x["period"] < y["period"], -1).otherwise(F.when(x["period"] > y["period"], 1).otherwise(0))), F.lit(0))
    digest = lambda x: F.sha2(F.encode(x, "UTF-8"), 256)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    done = done.withColumn("b", best)
    return done.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "b.start", "b.length", "b.period", F.floor(1000 * F.col("b.length") / F.col("b.period")).cast("long").alias("exponent_milli"),
        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
