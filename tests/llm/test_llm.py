"""Each operator against a plain version of itself, on tables with nulls, ties, repeats, clashing names and long texts."""

import hashlib
import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from veritrail.llm import ann, anchors, html_extract, html_training, lm_scoring, mixing, packing, quality, simhash, suffix_array, suffix_dedup, token_store, url_filter
from veritrail.llm.common import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, n string, size string, key string, fp string, `odd.name` string"


def corpus():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = text(90)
    out = [text(r.randint(1, 150)) for _ in range(25)]
    out += [out[3], out[3], out[3] + " x", f"{text(20)} {passage} {text(20)}", f"{passage} {text(9)}", f"{passage[:150]} {text(30)}"]
    out += ["", None, " \n\t ", "one", "a  b", "tab\tand  two spaces \n x", "# % & | < > $ * " * 20, "SHOUT!! LOUD!! " * 20, "same same same same same same same same", "x" * 3000]
    out += [text(6000), "line one\nline one\nline two\n \nline one", "héllo <|endoftext|> wörld", "Don't we'll 'tis 12,345.67"]
    rows = [(k, t, "en", (None, "a", "b", "c")[k % 4], 1, "h", "n", "s", "k", "f", "o") for k, t in enumerate(out)]
    return [*rows, rows[2], (None, *rows[5][1:]), (None, None, *rows[5][2:])]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def words(t):
    return WORD.findall(t or "")


def by_rows(got, want):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_tokens(docs, rows, spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    path = token_store.write_tokens(docs, tokenizer_path("byte_bpe_50k.json"), f"file://{tmp_path}/tokens")
    got = sorted(token_store.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    encode = lambda t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    by_rows([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], [(r[0], len(e := encode(r[1])), zlib.crc32(e.tobytes())) for r in rows])
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    data = bytes(spark.read.parquet(f"{path}/dictionary").first().data)
    blob = bytes(spark.read.parquet(f"{path}/shards").first().shard)
    shard = token_store.Shard(blob, data)
    text = {r[0]: r[1] for r in rows}
    last = shard.n - 1  # one document, without the others
    if shard.doc_id(last) is not None:
        assert (shard.ids(last) == encode(text[shard.doc_id(last)])).all()
    with pytest.raises(ValueError):
        token_store.Shard(blob, data + b"x")


def base_stats(t):
    w = words(t)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), dup, len(cover), n < 10 or 100 * len(cover) > 20 * n


def test_quality(docs, rows, spark):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(31)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_report(docs, labels).collect()
    by_rows([tuple(r)[:7] for r in got], [(r[0], *base_stats(r[1])) for r in rows])
    assert all(r.kept != r.base_failed for r in got)  # one kind of label teaches nothing
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_learns():
    r = np.random.default_rng(1)
    truth = lambda x: (x[:, 0] > 0.7) & (x[:, 1] < 0.5) | (x[:, 3] > 0.9)
    x, y = r.random((2, 3000, len(quality.FEATURES)))
    rules = quality.cover(x, truth(x))
    assert any(len(rule.tests) > 1 for rule in rules) and (quality.judged(rules, y) == truth(y)).mean() > 0.98


def test_quality_rules_in_order():
    """A rule of the other verdict comes first where that gains more, and decides."""
    r = np.random.default_rng(2)
    x, y = r.random((2, 4000, len(quality.FEATURES)))
    truth = lambda x: (x[:, 2] > 0.4) & (x[:, [0, 1, 4, 5, 6]] > 0.85).any(axis=1)
    rules = quality.cover(x, truth(x))
    assert not rules[0].poor and any(rule.poor for rule in rules)
    assert (quality.judged(rules, y) == truth(y)).mean() > 0.96


def test_quality_only_poor_left():
    x = np.zeros((300, len(quality.FEATURES)))
    x[:, 0] = np.arange(300) % 10
    assert (quality.judged(quality.cover(x, x[:, 0] > 7), x) == (x[:, 0] > 7)).all()


def plain_features(t):
    w = words(t)
    n, chars, symbols, dup, cover, _ = base_stats(t)
    share = lambda a, b: a / max(b, 1)
    lines = sum(bool(WORD.search(x)) for x in (t or "").split("\n"))
    upper, marks = sum(unicodedata.category(c) == "Lu" for c in t or ""), sum(c in ".,;:?" for c in t or "")
    digits, ends = sum(c in "0123456789" for c in t or ""), sum(x[-1] in "#*$%&|<>!" for x in w)
    return [share(symbols, n), share(cover, n), share(dup, lines), share(upper, chars), share((t or "").count("!"), n), share(marks, n), share(digits, chars), share(ends, n), share(len(set(w)), n)]


def test_quality_verdicts(spark):
    """The verdicts of a learned list in Spark are those of the list in plain Python; it is right on documents that it wasn't learned from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.learn(docs, labels)
    assert rules
    got = {r.doc_id: r for r in quality.quality_report(docs, labels).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    x = np.array([plain_features(t) for t in text.values()])
    poor = quality.judged(rules, x)
    for (d, t), bad in zip(text.items(), poor, strict=True):
        assert got[d].base_failed == base_stats(t)[5] and got[d].kept == (not (got[d].base_failed or bad))
    x, y = quality.labelled(*(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")))
    bad = quality.judged(quality.cover(x[::2], y[::2]), x[1::2])
    assert (bad & ~y[1::2]).sum() <= 0.05 * bad.sum() and (bad & y[1::2]).sum() >= 0.8 * y[1::2].sum()


def test_html_pages(spark):
    model = html_extract.default_model()
    wrong = total = 0
    for page in html_training.generate(80, 77):
        served, want = html_training.expected(page)
        a, b = Counter(html_extract.extract(served, model).split()), Counter(want.split())
        wrong += sum(((a - b) + (b - a)).values())
        total += sum(b.values())
    assert wrong < 0.02 * total
    without = html_extract.Model(model.weights, 0 * model.edge)  # messages do the work
    pages = [html_training.expected(page) for page in html_training.generate(40, 78)]
    lost = sum(sum(((a := Counter(html_extract.extract(s, without).split())) - (b := Counter(w.split())) | (b - a)).values()) for s, w in pages)
    assert lost > 0.2 * sum(len(w.split()) for _, w in pages)
    df = spark.createDataFrame([(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<article><p>A &amp; B<br>c\n d &#233;</p><p>e <b>f</b>g.</p></article><footer>no</footer>", "x"), (None, "u", "<", "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(df, model).collect()}
    assert got[1] == got[2] == ("", 0) and got[3] == ("A & B c d é e fg.", 17) and None in got


def test_html_details():
    model = html_extract.default_model()
    body = "<p>One sentence is here, with a mark.</p><p>Another one follows, as long as this.</p>"
    wanted = "One sentence is here, with a mark. Another one follows, as long as this."
    for attribute in ("class=it's", 'title=5"', "alt='a>b'", "data-x = \"'\""):
        assert html_extract.extract(f"<html><body><article><p {attribute}>First of all, a start.</p>{body}</article></body></html>", model) == f"First of all, a start. {wanted}"
    math = html_extract.extract("<article><p>The value of <math><mi>x</mi><mo>=</mo><mn>2</mn></math> is known, as we saw. <svg/>It is so.</p></article>", model)
    assert math == "The value of x=2 is known, as we saw. It is so."
    assert html_extract.extract("<article><p>a\u200bb and\u00a0more text, here.</p></article>", model) == "a\u200bb and more text, here."
    for page in ("<div>" * 100_000 + "x", "<b>" * 50_000 + "<div>x</div>" * 500 + "</i>" * 50_000, "<p><span>" * 50_000 + "</u>" * 50_000):
        began = time.perf_counter()
        html_extract.extract(page, model)
        assert time.perf_counter() - began < 10


def test_tree_marginals():
    """Messages give the marginals of the whole joint distribution."""
    tree = html_extract.Tree("<div><p>a</p><ul class=menu><li>b<li><b>c</b></ul></div>")
    r = np.random.default_rng(2)
    model = html_extract.Model(r.standard_normal(html_extract.N_FEATURES), r.standard_normal((html_extract.KINDS, 2, 2)))
    own = html_extract.features(tree) @ model.weights
    assert np.allclose(own, model.own(tree))
    n, kind = len(own), html_extract.kinds(tree)
    total, each = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [(bits >> i) & 1 for i in range(n)]
        p = math.exp(sum(own[i] * y[i] for i in range(n)) + sum(model.edge[kind[i], y[tree.parent[i]], y[i]] for i in range(1, n)))
        total += p
        each += p * np.array(y)
    assert np.allclose(model.marginals(tree), each / total)


def plain_print(t):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, rows):
    prints = [plain_print(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    least = lambda i: min((rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None), default=None)
    got = simhash.near_duplicates(docs).collect()
    by_rows(got, [(r[0], f"{prints[i]:016x}", least(i)) for i, r in enumerate(rows)])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for i, r in enumerate(rows) if r[0] == least(i)}


def test_simhash_links_hot_buckets(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 4, dtype=np.uint64)
    x = base[r.integers(0, 4, 600)]
    for _ in range(4):
        x = x ^ (np.uint64(1) << r.integers(0, 24, 600).astype(np.uint64))
    x = np.unique(x)
    want = np.array([[((int(a) ^ int(b)).bit_count() <= 2) for b in x] for a in x])
    i, j = np.nonzero(want)
    root = simhash.stars(len(x), i, j)
    nodes = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    for hot in (4096, 10):
        links = simhash.link_table(nodes, hot=hot).collect()
        at = {int(v): k for k, v in enumerate(x.view(np.int64))}
        got = simhash.stars(len(x), np.array([at[e.u] for e in links]), np.array([at[e.v] for e in links]))
        assert (got == root).all()


def plain_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    c = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if c[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [8192, 2])
def test_suffix_dedup(docs, rows, hot):
    want = plain_repeats([r[1] for r in rows])
    assert sum(w[2] > 0 for w in want) > 4
    by_rows(suffix_dedup.repeats_report(docs, hot).collect(), [(r[0], *w) for r, w in zip(rows, want, strict=True)])


@pytest.mark.parametrize("hot", [8192, 50])
def test_suffix_dedup_of_repeated_rows(spark, hot):
    """Many copies of a row and many texts that share a passage: at most two of equal contents are fetched."""
    r = random.Random(9)
    text = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(r.randint(2, 9))) for _ in range(n))
    passage, copy = text(50), text(120)
    items = [(k, f"{text(9)} {passage} {text(9)}") for k in range(60)] + [(900, copy)] * 500 + [(901, copy), (902, copy + " x"), (903, text(300))]
    want = plain_repeats([i[1] for i in items])
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    by_rows(suffix_dedup.repeats_report(df, hot).collect(), [(i[0], *w) for i, w in zip(items, want, strict=True)])


def test_suffix_dedup_rows(docs, rows):
    got = suffix_dedup.drop_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)


def test_suffix_order():
    r = np.random.default_rng(0)
    for _ in range(60):
        d = bytes(r.integers(97, 97 + int(r.integers(1, 4)), int(r.integers(1, 200))).astype(np.uint8)) + b"\0"
        text = np.frombuffer(d, np.uint8)
        order = suffix_array.suffix_order(d, np.ones(len(d), bool), len(d) + 1)
        assert order.tolist() == sorted(range(len(d)), key=lambda i: d[i:])
        lcp = suffix_array.common_prefixes(text, order, 50)
        for k in range(1, len(order)):
            a, b = d[order[k - 1] :], d[order[k] :]
            assert lcp[k] == min(50, next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))))


def test_sort_direct_makes_no_string_a_suffix():
    class Whole(bytes):
        def __getitem__(self, at):
            assert isinstance(at, int), "a suffix was copied"
            return super().__getitem__(at)

    r = np.random.default_rng(1)
    for _ in range(200):
        d = bytes(r.integers(int(r.choice([0, 97])), 99, int(r.integers(1, 80))).astype(np.uint8)) * int(r.integers(1, 9))
        at = np.flatnonzero(r.random(len(d)) < 0.7)
        for depth in (1, 13, 200, len(d) + 1):
            got = suffix_array.sort_direct(Whole(d), at, depth)
            assert [d[i : i + depth] for i in got] == sorted(d[i : i + depth] for i in at.tolist())


@pytest.mark.parametrize("hot", [2, 8192])
def test_only_hot_keys_are_counted_by_bytes(spark, rows, hot, monkeypatch):
    """The bytes of all other keys are dealt once, to be sorted, and meet no join."""
    plans = []

    def noted(df, name, settle=suffix_dedup.settle):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return settle(df, name)

    monkeypatch.setattr(suffix_dedup, "settle", noted)
    suffix_dedup.covered(spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string"), hot)
    after = plans[[name for name, _ in plans].index("repeat-bytes") + 1 :]
    assert after[0][0] == "repeat-found" and "Join" not in after[0][1]
    assert (len(after) > 1) == (hot == 2)
    assert all("hot" in plan for name, plan in after[1:3])


def test_anchor_runs_cover_every_window():
    texts = [b"", b"x" * 199, b"ab" * 700, bytes(np.random.default_rng(1).integers(0, 256, 300_000).astype(np.uint8))]
    found = anchors.runs(texts, anchors.Roller())
    for i, t in enumerate(texts):
        own = found["text"] == i
        assert found["count"][own].sum() == max(0, len(t) - 199)


def test_neighbours(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((900, 24)).astype(np.float32)
    x[100:160] = x[50]
    items = [(i, v.tolist(), 0, "v") for i, v in enumerate(x)] + [(901, None, 0, "v"), (902, [0.0] * 24, 0, "v"), (903, [float("nan")] * 24, 0, "v"), (904, [None] * 24, 0, "v"), (905, [], 0, "v")]
    df = spark.createDataFrame(items, "vec_id long, embedding array<float>, label int, v string").repartition(3)
    got: dict = {}
    for row in ann.nearest(df, rows=300, queries=8).collect():
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    d = ann.scaled(x.astype(float))
    norm = np.sqrt((d * d).sum(axis=1))
    hits = 0
    assert set(got) == set(range(0, 900, 50))
    for q, found in got.items():
        s = (d * d[q]).sum(axis=1) / (norm * norm[q])
        s[q] = -9
        best = np.lexsort((np.arange(900), -s))[:5].tolist()
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(f[2] == pytest.approx(s[f[1]], rel=1e-14) for f in found)
        hits += len({f[1] for f in found} & set(best))
    assert hits >= 0.9 * 5 * len(got)
    few = ann.nearest(df.filter("vec_id < 3")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]


def test_neighbours_of_repeated_rows(spark):
    """Repeated ids and vectors, ties at the last rank, and components near the end of the range."""
    r = np.random.default_rng(6)
    x = r.integers(-2, 3, (60, 4)).astype(float)
    x[0] = [1, 0, 0, 0]
    x[1:4] = [1e200, 1e200, 0, 0]
    x[4] = [3e-320, 3e-320, 0, 0]
    x[20:50] = [1, 1, 0, 0]
    ids = [int(k) for k in np.arange(60)]
    ids[40:45] = [50, 50, 50, 100, 100]
    ids[50] = 0
    use = np.flatnonzero((x != 0).any(axis=1))
    df = spark.createDataFrame([(ids[k], x[k].tolist()) for k in range(60)] + [(None, [1.0] * 4)], "vec_id long, embedding array<double>").repartition(4)
    got = Counter((q.query_id, q.rank, q.vec_id, q.score) for q in ann.nearest(df, rows=20, queries=2).collect())
    want: Counter = Counter()
    for q in use:
        if ids[q] % 50 == 0:
            near = sorted((-float(ann.cosines(x[q : q + 1], x[k : k + 1])[0]), ids[k]) for k in use if k != q)[:5]
            want.update((ids[q], n + 1, i, -s) for n, (s, i) in enumerate(near))
    assert got == want


def test_rotations():
    """Norms and cosines stay, whatever the length; estimates are within their bounds nearly always; a worker keeps few matrices."""
    r = np.random.default_rng(1)
    for d in (3, 64, 600, 2048, 2049, 5000):
        x = r.standard_normal((6, d))
        y = ann.rotated(x)
        assert y.shape == (6, ann.code_bits(d)) and np.allclose(y @ y.T, x @ x.T)
        c = ann.encode(r.standard_normal((40, d)))
        assert c["words"].shape[1] * 64 == ann.code_bits(d)
    x = r.standard_normal((60, 3000))
    x[30:] += x[:30]
    guess, bound = ann.estimate(ann.encode(x), ann.encode(x))
    exact = (x @ x.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((x * x).sum(1))[None, :]
    off = ~np.eye(60, dtype=bool)
    assert (np.abs(guess - exact) <= bound)[off].mean() > 0.97
    for d in range(5, 25):
        ann.rotated(r.standard_normal((1, d)))
    assert len(ann.process_store()["rotations"]) <= ann.ROTATIONS


def test_long_vectors(spark):
    r = np.random.default_rng(2)
    x = {k: r.standard_normal(64 if k % 3 else 3000).tolist() for k in range(0, 200)}
    got = ann.nearest(spark.createDataFrame([(k, v) for k, v in x.items()], "vec_id long, embedding array<float>")).collect()
    assert {(g.query_id, g["rank"]) for g in got} == {(q, n) for q in range(0, 200, 50) for n in range(1, 6)}
    assert all(len(x[g.query_id]) == len(x[g.vec_id]) for g in got)


def test_urls(spark):
    urls = ["http://A.Example.ORG/es/1?x", "https://example.org/en/12", "https://notexample.org/en/12", "http://x.com/fr/", "http://x.com/fr", "http://x.com/de/#a", "http://casino.net/", None, "no scheme", "http://", "http://org/", "a://b://c/d", "http://www.free-bets.example.net?q", "http://casino.net/"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[1][2:] == ("example.org/en/1", "block") and got[2][2:] == ("org/", "allow")
    assert got[3][2:] == ("com/fr/", "allow") and got[4][2:] == (None, "allow") and got[5][1:] == ("/de/", "com/de/", "block") and got[6][2:] == (None, "block") == got[13][2:]
    assert got[7] == got[8] == got[9] == ("", "", None, "allow") and got[10][2] == "org/" and got[11][:2] == ("b:", "//c/d") and got[12] == ("www.free-bets.example.net", "", None, "block")


def test_cascade_is_exact(spark):
    keys = [(f"host{k}.example", k % 7 == 0) for k in range(4000)]
    df = spark.createDataFrame(keys, "key string, listed boolean")
    for rate in (0.3, 0.01):
        c = url_filter.build_cascade(df, rate)
        assert df.filter(c.listed(F.col("key")) != F.col("listed")).count() == 0 and len(c.levels) > 1
    pages = spark.createDataFrame([(k, f"http://{h}/") for k, (h, _) in enumerate(keys[:100])], "page_id long, url string")
    listed = spark.createDataFrame([(k,) for k, yes in keys if yes] + [(None,), ("no.such",)], "key string")
    for shard_keys, at_once in ((500_000, 16), (4, 2)):  # one shard, and several passes
        judged = url_filter.judge_urls(pages, (), listed=listed, shard_keys=shard_keys, at_once=at_once)
        assert "Join" not in judged._jdf.queryExecution().executedPlan().toString()
        assert all((r.verdict == "block") == (r.page_id % 7 == 0) for r in judged.collect())


def test_hosts_of_many_labels(spark):
    long = ".".join(f"l{k % 7}" for k in range(12_000))
    urls = [f"http://{long}/a/b", "http://x.casino.net/", f"http://{long}.casino.net/", f"http://{long}.example.net/"]
    judge = lambda: [r.verdict for r in url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()]
    judge()  # what is measured is not the first run's compilation
    began = time.monotonic()
    assert judge() == ["allow", "block", "block", "allow"] and time.monotonic() - began < 30
    assert url_filter.label_counts(spark.createDataFrame([("a.b",), ("c",), ("d.e",), ("x.y.z/q/",)], "key string")) == [1, 2]


def test_shards_are_built_together(spark):
    universe = spark.createDataFrame([(f"host{k}.example", k % 5 == 0) for k in range(3000)], "key string, listed boolean")
    both = url_filter.build_cascades(universe, 4, (0, 2), 0.2)
    listed = url_filter.in_shards(both, 4)
    mine = universe.filter(url_filter.shard_of(F.col("key"), 4).isin(0, 2))
    assert set(both) == {0, 2} and mine.filter(listed(F.col("key")) != F.col("listed")).count() == 0 and mine.count() > 1000
    assert universe.filter(~url_filter.shard_of(F.col("key"), 4).isin(0, 2) & listed(F.col("key"))).count() == 0


def test_listed_domains_and_directories(spark):
    urls = ["http://a.b.example/x/1", "http://b.example/", "http://xb.example/", "http://c.example/y/z/1?q", "http://c.example/y2/z", "http://c.example/y", "http://d.c.example/y/z", None]
    listed = spark.createDataFrame([("b.example",), ("c.example/y/",)], "key string")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(df, (), listed=listed).collect()}
    assert [got[k] for k in range(len(urls))] == ["block", "block", "allow", "block", "allow", "allow", "allow", "allow"]
    many = spark.createDataFrame([(k, f"http://e.example/{'ads' if k < 5 else 'news'}/{k}{'?utm_source=x' if k in (0, 1, 2, 7) else ''}") for k in range(10)], "page_id long, url string")
    assert {r.page_id for r in url_filter.judge_urls(many).collect() if r.verdict == "block"} == set(range(5))


def test_mixing(docs, rows):
    size = [len(words(r[1])) for r in rows]
    source: dict = {}
    for r, n in zip(rows, size, strict=True):
        source[r[3]] = source.get(r[3], 0) + n
    order = sorted(source, key=lambda s: (s is None, s or ""))
    target, free, left = {}, {s: k % 3 + 1 for k, s in enumerate(order)}, float(sum(size))
    while free:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        above = [s for s in free if share[s] > 3 * source[s]]
        for s in above or list(free):
            target[s] = 3.0 * source[s] if above else share[s]
            left -= target[s] if above else 0
            del free[s]
    got = mixing.mix_report(docs).collect()
    by_rows([(r.doc_id, r["size"], r.source_size) for r in got], [(r[0], n, source[r[3]]) for r, n in zip(rows, size, strict=True)])
    of = {}
    for r in got:
        assert r.taken <= 3 * r["size"]
        of.setdefault(r.source_size, [r.target, 0, 0])[1] += r.taken
        of[r.source_size][2] = max(of[r.source_size][2], r["size"])
    for s in order:
        t, taken, largest = of[source[s]]
        assert abs(t - target[s]) < 1e-6 and abs(taken - t) <= largest
    by_rows(mixing.mix_report(docs.repartition(7)).collect(), [tuple(r) for r in got])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.select(F.sum(F.regexp_count("text", F.lit(WORD.pattern)))).first()[0] == sum(r.taken for r in got)


def test_mixing_of_many_sources(spark, monkeypatch):
    """The same mix if the sources are too many to broadcast, with one of them far ahead."""
    rows = [(k, "w " * (k % 13), "hot" if k % 3 == 0 else f"s{k % 200}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = mixing.mix_report(docs).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    by_rows(mixing.mix_report(docs).collect(), [tuple(r) for r in want])
    by_rows(mixing.mix(docs).filter("text <> ''").groupBy("doc_id").count().collect(), [(r.doc_id, r.taken // r["size"]) for r in want if r.taken])


def test_packing(docs, rows):
    got = packing.pack_documents(docs, (16, 64, 128), block=20).collect()
    bins: dict = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        used = sum(r.n_words for r in b)
        assert b[0].bin_capacity == min(c for c in (16, 64, 128) if c >= used)
        at = 0
        for r in sorted(b, key=lambda r: (r.place, r.n_words)):
            assert r.place == at
            at += r.n_words
    assert sum(r.n_words for r in got) == sum(len(words(r[1])) for r in rows)
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r[0] for r in rows)
    assert packing.pack([]) == ([], [], [])
    many = docs.sparkSession.createDataFrame([(1, "a b c")] * 700 + [(2, "d e")], "doc_id long, text string")
    packed = packing.pack_documents(many, (16, 64), block=50)
    assert packed.count() == 701 and packed.groupBy(F.shiftright("bin_id", 32)).count().agg(F.max("count")).first()[0] <= 4 * packing.COPIES


def plain_best_fit(sizes, capacities, final):
    """The same rules with a plain list of bins: (sorted contents and capacity of each bin)."""
    bins = []  # [capacity, pieces]
    order = sorted(sizes, reverse=True)
    for k, s in enumerate(order):
        fits = [b for b in bins if b[0] - sum(b[1]) >= s]
        if fits:
            least = min(b[0] - sum(b[1]) for b in fits)
            next(b for b in reversed(fits) if b[0] - sum(b[1]) == least)[1].append(s)
        else:
            each = {c: packing.cost(c) / max(1, min(c, s + sum(x for x in order[k + 1 :] if x <= c - s))) for c in capacities if c >= s}
            bins.append([min(each, key=lambda c: (each[c], c)), [s]])
    return sorted((min(c for c in final if c >= sum(p)), sum(p)) for _, p in bins)


def test_best_fit_is_joint():
    r = random.Random(7)
    for trial in range(30):
        sizes = [min(100, int(r.paretovariate(0.8) * 4)) for _ in range(r.randint(1, 80))]
        final = [16, 32, 64, 128]
        plans = {}
        for n in range(1, 5):
            for some in combinations(final, n):
                if some[-1] >= max(sizes):
                    where, _, capacity = packing.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, some, final)
                    used = Counter()
                    for b, s in zip(where, sizes, strict=True):
                        used[b] += s
                    want = plain_best_fit(sizes, some, final)
                    assert Counter(c for c, _ in want) == Counter(capacity) or sum(capacity) == sum(c for c, _ in want)
                    assert all(used[b] <= c for b, c in enumerate(capacity))
                    plans[some] = sum(map(packing.cost, capacity))
        assert sum(map(packing.cost, packing.pack(sizes, final)[2])) == min(plans.values())
    sizes = [int(r.paretovariate(0.9) * 60) % 4000 for _ in range(800)]
    alone = min(sum(map(packing.cost, packing.best_fit(sorted(range(800), key=lambda i: -sizes[i]), sizes, (c,), list(packing.CAPACITIES))[2])) for c in packing.CAPACITIES if c >= max(sizes))
    best = packing.pack(sizes)
    assert sum(map(packing.cost, best[2])) < 0.95 * alone and len(set(best[2])) > 1


def test_scores(docs, rows, monkeypatch):
    monkeypatch.setattr(lm_scoring, "UNIT_BYTES", 4000)
    monkeypatch.setattr(lm_scoring, "JOIN_BYTES", 1000)
    tokens = [[*(t or "").encode().lower().split(), None] for _, t, *_ in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    tunes = [not h and (r[0] is None or zlib.crc32(str(r[0]).encode()) // 7 % 8 == 0) for r, h in zip(rows, held, strict=True)]

    marked = [["<", *w] for w in tokens]

    def counted(use):
        one, two, three = Counter(), Counter(), Counter()
        for w, m, u in zip(tokens, marked, use, strict=True):
            if u:
                one.update(w)
                two.update(zip(m, m[1:]))  # noqa: B905
                three.update([(None, *m[:2])])
                three.update(zip(m, m[1:], m[2:]))  # noqa: B905
        one["<"] = sum(use)
        return one, two, three

    def learned(items):
        """Expectation-maximisation n-gram by n-gram."""
        out = {}
        for bucket in {b for b, *_ in items}:
            k = [1 / 4] * 4
            own = [(times, p) for b, times, p in items if b == bucket]
            for _ in range(50):
                new = [0.0] * 4
                for times, p in own:
                    total = sum(x * y for x, y in zip(k, p, strict=True))
                    new = [x + times * y * z / total for x, y, z in zip(new, k, p, strict=True)]
                k = [x / sum(new) for x in new]
            out[bucket] = k
        return out

    full, fit, tune = counted([not h for h in held]), counted([not h and not t for h, t in zip(held, tunes, strict=True)]), counted(tunes)
    size = lambda c: sum(c[0].values()) - c[0]["<"]

    level = lambda c: int(math.log2(c + 1))
    bucket = lambda c, u, v: level(c[1][u, v]) if c[1][u, v] else 32 + level(c[0][v])
    parts = lambda c, u, v, w: (c[2][u, v, w] / max(c[1][u, v], 1) * (c[1][u, v] > 0), c[1][v, w] / max(c[0][v], 1), c[0][w] / size(c), 1 / (n_kinds + 1))
    n, n_kinds = size(full), len(full[0]) - 1
    v = n_kinds
    mix = learned([(bucket(fit, *x[:2]), times, parts(fit, *x)) for x, times in tune[2].items()])
    want = []
    for r, w, m, h in zip(rows, tokens, marked, held, strict=True):
        base = sum(math.log10((full[0][x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for x in zip([None, *m], m, m[1:]):  # noqa: B905
            k = mix.get(bucket(full, *x[:2]), (0, 0, 0.9, 0.1))
            score += math.log10(sum(y * z for y, z in zip(k, parts(full, *x), strict=True)))
        want.append((r[0], h, len(w), sum(full[0][x] > 0 for x in w), n, base, score))
    got = lm_scoring.lm_scores(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, e in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == e[:5] and g[5] == pytest.approx(e[5], rel=1e-9) and g[6] == pytest.approx(e[6], rel=0.005)  # weights come from cells of like probabilities


def test_mixture_prefers_better_models():
    """On text that follows pairs, the pair model gets the weight; weights add up to one."""
    stats = lm_scoring.statistics(np.full(500, 5.0), np.full(500, 7), [np.full(500, 0.0), np.full(500, 40 / 41), np.full(500, 40 / 20_000)])
    w = lm_scoring.mixture(list(zip(*(c.to_pylist() for c in stats.columns), strict=True)), 500)
    assert w[7, 1] > 0.9 and np.allclose(w.sum(axis=1), 1)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert token_store.read_tokens(spark, token_store.write_tokens(none, tokenizer_path("byte_bpe_50k.json"))).count() == 0
    for df in (
        quality.quality_report(none, labels), quality.keep_good(none, labels), html_extract.extract_text(pages), simhash.near_duplicates(none), simhash.drop_near_duplicates(none),
        suffix_dedup.repeats_report(none), suffix_dedup.drop_repeats(none), ann.nearest(vectors), url_filter.judge_urls(pages), mixing.mix_report(none), mixing.mix(none),
        packing.pack_documents(none), lm_scoring.lm_scores(none),
    ):
        assert df.count() == 0


def test_suffix_dedup_texts(docs, rows):
    """The kept text is what the report's hash is of, where no character is cut."""
    report = {(r.doc_id, r.n_bytes): r for r in suffix_dedup.repeats_report(docs).collect()}
    before = {r[0]: r[1] for r in rows}
    for r in suffix_dedup.drop_repeats(docs).collect():
        if r.doc_id is None:
            continue
        was = report[r.doc_id, len((before[r.doc_id] or "").encode())]
        if not was.n_removed:
            assert r.text == before[r.doc_id]
        elif len(r.text.encode()) == was.n_bytes - was.n_removed:
            assert hashlib.sha256(r.text.encode()).hexdigest() == was.kept_sha256
        else:
            assert 0 <= was.n_bytes - was.n_removed - len(r.text.encode()) <= 3 * 2 * was.n_spans
