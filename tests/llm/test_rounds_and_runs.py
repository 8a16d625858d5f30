"""Sharding, periodic runs and phrases against plain versions, on tables with nulls, ties, repeats, clashing names and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritrail.llm import phrases, runs, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, size string, shard string, runs string, `_hash` string, `odd.name` string"


def corpus():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "ÉTÉ"]
    some = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    texts = [some(r.randint(1, 60)) for _ in range(60)]
    texts += [None, "", " \n\t ", "one", "A, b; c.", "the cat sat. " * 30, "tab\tand  two  spaces", "a a " * 400, some(5000), "x" * 4000, "p q r " * 8 + "p q"]
    texts += [texts[3]] * 30
    rows = [(k, t, (None, "en", "und", "fr")[k % 4], "s", "h", "r", "x", "o") for k, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, *rows[5][1:]), (None, None, *rows[5][2:]), *[rows[4]] * 40]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def check_shards(got, n_shards, tolerance):
    """Shards are gapless stretches of one order, cut within tolerance or at the nearest row."""
    total, ideal = sum(r.size for r in got), sum(r.size for r in got) / n_shards
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    assert set(by_shard) <= set(range(n_shards))
    below, edges = 0, [0]
    order = [r for s in range(n_shards) for r in sorted(by_shard[s], key=lambda r: r.slot)]
    for r in order:
        edges.append(edges[-1] + r.size)
    for s in range(n_shards - 1):
        assert sorted(r.slot for r in by_shard[s]) == list(range(len(by_shard[s])))
        below += sum(r.size for r in by_shard[s])
        want = total * (s + 1) // n_shards
        assert abs(below - want) <= max(ideal * tolerance, min(abs(e - want) for e in edges)), s
    texts = [r.text for r in order]
    assert len([1 for i, t in enumerate(texts) if i == 0 or t != texts[i - 1]]) == len(set(texts))  # equal texts stand together


@pytest.mark.parametrize(("n", "cell"), [(40, 1 << 26), (3, 700), (1, 1 << 26), (500, 1 << 26)])
def test_shards(docs, rows, n, cell):
    got = sharding.shard_documents(docs, n, cell_bytes=cell).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert all(r.size == len((r.text or "").encode()) + 16 and r["odd.name"] == "o" and r["_hash"] == "x" for r in got)
    check_shards(got, n, sharding.TOLERANCE)


def test_shards_cut_a_hot_row(spark):
    """A third of all rows alike in every column, and reruns agree."""
    hot = F.col("id") % 3 == 0
    df = spark.range(6000).select(F.when(hot, 7).otherwise(F.col("id")).alias("doc_id"), F.when(hot, F.lit("x" * 50)).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = sharding.shard_documents(df).collect()
    check_shards(got, 40, sharding.TOLERANCE)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 150
    other = lambda df: Counter((r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(df).collect())
    assert other(df) == other(df.repartition(7)) == Counter((r.doc_id, r.shard, r.slot) for r in got)


def test_shard_report(docs, rows, spark):
    got = sharding.shard_report(docs).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((r[0], zlib.crc32((r[1] or "").encode())) for r in rows)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    assert sharding.shard_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_number_of_probes_below():
    r = np.random.default_rng(0)
    probes = np.array(sorted(map(tuple, r.integers(0, 4, (30, 3)).tolist())), np.int64)
    keys = r.integers(0, 4, (200, 3))
    want = [sum(tuple(p) <= tuple(k) for p in probes.tolist()) for k in keys.tolist()]
    assert sharding.below(probes, *keys.T.astype(np.int64)).tolist() == want


def plain_runs(w, least=12):
    """Every period from 1 on, from left to right."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted([(s, size, q) for (s, size), q in out.items()], key=lambda x: (x[0], x[2]))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=70), min_size=1, max_size=4), st.integers(2, 9))
def test_runs_of_few_words(texts, p):
    texts += [[t[i % p] for i in range(60)] for t in texts if len(t) >= p]
    assert [[tuple(x) for x in g.tolist()] for g in runs.runs_of(texts)] == [plain_runs(t) for t in texts]


def test_runs_of_many_words():
    r = random.Random(2)
    base = [b"%d" % r.randrange(300) for _ in range(700)]
    texts = [base + base[:650] + base, [b"a"] * 5000, base[:37] * 40 + [b"x"] + base[:37] * 3, base]
    assert [[tuple(x) for x in g.tolist()] for g in runs.runs_of(texts)] == [plain_runs(t) for t in texts]


def test_runs(docs, rows, spark):
    want = []
    for doc_id, text, *_ in rows:
        w = planted(doc_id, text)
        found = plain_runs(w)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        gone = {i for s, size, q in found for i in range(s + q, s + size)}
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, digest("".join(f"{s},{size},{q}\n" for s, size, q in found)), digest(" ".join(x for i, x in enumerate(w) if i not in gone))))
    got = Counter(map(tuple, runs.runs_report(docs).collect()))
    assert got == Counter(want)
    assert sum(n for w, n in got.items() if w[1]) > 5
    assert runs.runs_report(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = runs.find_runs(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter(r[0] for r in rows) and {r["odd.name"] for r in kept} == {"o"}
    assert all(r.n_words == len(WORD.findall(r.text or "")) for r in kept)


def plain_phrases(rows, least, first, most=5):
    counts, totals = Counter(), Counter()
    ascii_lower = {c: c + 32 for c in range(65, 91)}
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ascii_lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, most + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {p: a for p, a in counts.items() if a >= least and len(p[1]) > 1}
    inside = Counter()
    for (lang, w), a in found.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside[lang, w[i:j]], a)
    out = []
    for lang in totals:
        mine = []
        for (at, w), a in found.items():
            if at == lang and not 100 * inside[lang, w] >= 100 * a:
                cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                mine.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, totals[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(mine)[:first], 1)]
    return out


@pytest.mark.parametrize(("least", "first"), [(100, 2000), (3, 2000), (1, 50)])
def test_phrases(docs, rows, least, first, monkeypatch):
    if least == 3:
        monkeypatch.setattr(phrases, "SENT", 400)  # several passes a level
        monkeypatch.setattr(phrases, "HELD", 50)
    got = phrases.mine_phrases(docs, least=least, first=first).collect()
    assert sorted(map(tuple, got)) == sorted(plain_phrases(rows, least, first))


def test_no_phrases(spark):
    assert phrases.mine_phrases(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.mine_phrases(spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id long, text string, lang string")).count() == 0
