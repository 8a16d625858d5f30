"""Quality rules: fixed base limits, then a learned decision list, all as Spark expressions.

The list is grown by sequential covering on the statistics of labelled documents that pass the base limits: a rule is a conjunction
of threshold tests with a verdict, "poor" or "good". Each round grows a rule of either kind on two thirds of what is left while it gains,
prunes any of its tests on the other third, and takes the one of more gain, if its verdict is precise on both parts, each by itself. What it covers is
taken out before the next one, so a rule is to be read with those before it. The rules
become an ordered conditional expression, after the base limits, whose default is "kept".

Edge cases: a null or empty text has no words and fails the base limits. Repeated rows are judged
alike. Without labels of both kinds the list is empty and the base limits alone decide. Labels with a
null id or quality are left out; of several labels of an id the least counts. Texts of any length are counted whole: a text's words and windows of five words stand
in one row's arrays, some ten times the text. An empty table gives an empty table. Further columns of documents, whatever
their names, are kept by keep_good() and ignored by quality_report().
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import SPACE, WORD, free_name

MAX_LABELLED = 8192  #: labelled documents learned from, those of the smallest id hashes
WINDOW = 5
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_shouts", "n_lines", "n_marks", "n_digits", "n_marked_words", "n_kinds")
BASE = COUNTS[:5]
#: Learned from: numerator and denominator counts.
#: Length alone is no sign of quality, so word and document lengths are not among them.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "digit_share": ("n_digits", "word_chars"),
    "marked_word_share": ("n_marked_words", "n_words"),
    "distinct_share": ("n_kinds", "n_words"),
}
CANDIDATES, MAX_RULES, MAX_TESTS = 64, 16, 4
LEAST_PRECISION, LEAST_COVER = 0.95, 5


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def column(self, features: dict[str, Column]) -> Column:
        x = features[self.feature]
        return x > self.limit if self.above else x <= self.limit

    def on(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.feature)]
        return v > self.limit if self.above else v <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


Tests = tuple[Test, ...]


@dataclass(frozen=True)
class Rule:
    tests: Tests
    poor: bool

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.tests))}: {'poor' if self.poor else 'good'}"


def with_counts(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with one more column, a struct of COUNTS; and that column's name.

    Windows of words are compared by the hash of their words' 64-bit hashes. Only where some window
    repeats are windows sorted with their places, to count the words that repeated ones cover.
    """
    at = free_name(docs, "quality")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    c = {k: F.col(f"{at}_{k}") for k in ("text", "hashes", "lines", "windows", "sorted", "places")}

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(c["hashes"], i + j) for j in range(WINDOW)])

    df = docs.select(*kept, text.alias(f"{at}_text"), F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda x: F.xxhash64(x)).alias(f"{at}_hashes"), lines.alias(f"{at}_lines"))
    n = F.size(c["hashes"])
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window_hash)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(f"{at}_windows", windows)
    repeats = F.size(F.array_distinct(c["windows"])) < F.size(c["windows"])
    pairs = F.when(repeats, F.sort_array(F.transform(c["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn(f"{at}_sorted", pairs)

    def twin(x: Column, j: Column) -> Column:
        other = lambda k: F.get(c["sorted"], k)["h"]
        return F.coalesce(other(j - 1) == x["h"], F.lit(False)) | F.coalesce(other(j + 1) == x["h"], F.lit(False))

    df = df.withColumn(f"{at}_places", F.sort_array(F.transform(F.filter(c["sorted"], twin), lambda x: x["i"])))
    steps = F.zip_with(c["places"], F.slice(c["places"], 2, F.greatest(F.size(c["places"]) - 1, F.lit(0))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(c["text"], SPACE, "")),
        "n_symbols": F.regexp_count(c["text"], F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size(c["lines"]) - F.size(F.array_distinct(c["lines"])),
        "n_repeat_words": covered,
        "n_upper": F.regexp_count(c["text"], F.lit(r"\p{Lu}")),
        "n_shouts": F.regexp_count(c["text"], F.lit(r"!")),
        "n_lines": F.size(c["lines"]),
        "n_marks": F.regexp_count(c["text"], F.lit(r"[.,;:?]")),
        "n_digits": F.regexp_count(c["text"], F.lit(r"[0-9]")),
        "n_marked_words": F.regexp_count(c["text"], F.lit(r"[#*$%&|<>!](?=[\x20\x09-\x0D]|\z)")),
        "n_kinds": F.size(F.array_distinct(c["hashes"])),
    }
    # filters are not pushed below a generator, where they would repeat the counting for each of their tests
    return df.select(*kept, F.explode(F.array(F.struct(*[v.cast("long").alias(k) for k, v in counts.items()]))).alias(at)), at


def base_failed(at: str) -> Column:
    n = F.col(f"{at}.n_words")
    return (n < LEAST_WORDS) | (100 * F.col(f"{at}.n_repeat_words") > MOST_REPEATED_PERCENT * n)


def features(at: str) -> dict[str, Column]:
    def ratio(a: str, b: str) -> Column:
        return F.col(f"{at}.{a}").cast("double") / F.greatest(F.col(f"{at}.{b}"), F.lit(1))

    return {k: ratio(*v) for k, v in FEATURES.items()}


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(features, poor) of at most MAX_LABELLED labelled documents (a documented bound) that pass the base limits, in the order of their ids' hashes."""
    good = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna()
    order = F.xxhash64("doc_id")
    sample = good.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(order, "doc_id").limit(MAX_LABELLED)
    ids = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # MAX_LABELLED rows at most
    counted, at = with_counts(ids)
    values = [v.alias(k) for k, v in features(at).items()]
    rows = counted.filter(~base_failed(at)).select("doc_id", "quality", *values).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).collect()
    return np.array([r[2:] for r in rows], dtype=float).reshape(-1, len(FEATURES)), np.array([r[1] == 0 for r in rows], bool)


def learn(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    return cover(*labelled(docs, labels))


def cover(x: np.ndarray, poor: np.ndarray) -> list[Rule]:
    """Sequential covering: one rule after another on the rows that are left."""
    rules: list[Rule] = []
    third = np.arange(len(x)) % 3 == 0  # rows come in hash order
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and (left & poor).any():
        best, most = None, 0.0
        for says in (True, False):
            y = poor == says
            seen = left if (left & ~y).any() else left | ~y  # if no other row is left, told apart from those covered before
            tests = prune(grow(x[seen & ~third], y[seen & ~third]), x[seen & third], y[seen & third])
            hit = left & fits(tests, x)
            if tests and all(precise(hit & part, y) for part in (third, ~third)) and (hit & y).sum() >= LEAST_COVER:
                gain = (hit & y).sum() * (np.log2((hit & y).sum() / hit.sum()) - np.log2((seen & y).sum() / seen.sum()))
                if gain > most:
                    best, most = Rule(tests, says), gain
        if best is None:
            break
        rules.append(best)
        left &= ~fits(best.tests, x)
    while rules and not rules[-1].poor:  # the default says the same
        rules.pop()
    return rules


def precise(hit: np.ndarray, y: np.ndarray) -> bool:
    return bool(hit.any()) and (hit & y).sum() >= LEAST_PRECISION * hit.sum()


def fits(tests: Tests, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in tests:
        out &= test.on(x)
    return out


def judged(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """Poor by the list: the first rule that fits decides."""
    out, left = np.zeros(len(x), bool), np.ones(len(x), bool)
    for rule in rules:
        hit = left & fits(rule.tests, x)
        out |= hit & rule.poor
        left &= ~hit
    return out


def grow(x: np.ndarray, y: np.ndarray) -> Tests:
    """Add the test of the largest information gain until the rule covers no other row or nothing gains."""
    tests: Tests = ()
    inside = np.ones(len(x), bool)
    while len(tests) < MAX_TESTS and (inside & ~y).any() and (inside & y).any():
        p, n = (inside & y).sum(), (inside & ~y).sum()
        was, best = np.log2(p / (p + n)), (0.0, None)
        for k, name in enumerate(FEATURES):
            v, of = x[inside, k], y[inside]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, CANDIDATES + 1), method="lower"))
            edges = np.searchsorted(cuts, v)  # rows with v <= cuts[j] have edges <= j
            ps, ns = (np.cumsum(np.bincount(edges[m], minlength=len(cuts))) for m in (of, ~of))
            for above, (a, b) in ((False, (ps, ns)), (True, (p - ps, n - ns))):
                gain = a * (np.log2(np.maximum(a, 1e-9) / np.maximum(a + b, 1e-9)) - was)
                j = int(np.argmax(gain))
                if gain[j] > best[0] + 1e-9:
                    best = (float(gain[j]), Test(name, above, float(middle(v, cuts[j]))))
        if best[1] is None:
            break
        tests += (best[1],)
        inside &= best[1].on(x)
    return tests


def middle(v: np.ndarray, cut: float) -> float:
    """Half way from cut to the next larger value, or cut where there is none."""
    above = v[v > cut]
    return (cut + above.min()) / 2 if len(above) else cut


def prune(tests: Tests, x: np.ndarray, y: np.ndarray) -> Tests:
    """Leave out one test after another while (p - n) / (p + n) doesn't fall on rows that the rule wasn't grown on."""

    def worth(of: Tests) -> float:
        hit = fits(of, x)
        p, n = (hit & y).sum(), (hit & ~y).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(tests) > 1:
        shorter = max((tests[:k] + tests[k + 1 :] for k in range(len(tests) - 1, -1, -1)), key=worth)
        if worth(shorter) < worth(tests):
            break
        tests = shorter
    return tests


def verdict(rules: list[Rule], at: str) -> Column:
    """The ordered conditional expression: true is kept."""
    f = features(at)
    out = F.when(base_failed(at), F.lit(False))
    for rule in rules:
        test = rule.tests[0].column(f)
        for more in rule.tests[1:]:
            test = test & more.column(f)
        out = out.when(test, F.lit(not rule.poor))
    return out.otherwise(F.lit(True))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept) of every document."""
    rules = learn(docs, labels)
    counted, at = with_counts(docs.select("doc_id", "text"))
    return counted.select("doc_id", *[F.col(f"{at}.{k}").alias(k) for k in BASE], base_failed(at).alias("base_failed"), verdict(rules, at).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with the columns of docs."""
    rules = learn(docs, labels)
    counted, at = with_counts(docs)
    return counted.filter(verdict(rules, at)).drop(at)
