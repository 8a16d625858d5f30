"""Near-dedup of the pipeline against similarities of all pairs."""

import random

import pytest

import corpus_pipeline
from veritrail.llm import similar, simhash, suffix_dedup

SF = "/root/testdata/sf0.01"


def plain_set(text):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_kept(rows):
    """Ids of the first row of each component of pairs with a Jaccard similarity of 0.8 or more, and the number of links."""
    sets = [plain_set(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                common = len(a & b)
                if 5 * common >= 4 * (len(a) + len(b) - common):
                    links += a != b
                    group[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        least[root(i)] = min(least.get(root(i), key), key)
    return sorted(None if none else k for none, k in least.values() if not none) + [None] * sum(none for none, _ in least.values()), links


def ids(df):
    got = [r.doc_id for r in df.select("doc_id").collect()]
    return sorted(x for x in got if x is not None) + [None] * got.count(None)


def test_all_pairs_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, links = plain_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert links >= 5
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    assert ids(stage(spark, docs, SF)) == want


@pytest.mark.parametrize(("hot", "leaders", "tile", "tiles"), [(4096, 32, 256, 16), (10, 2, 8, 16), (10, 2, 8, 1)])
def test_large_groups(spark, monkeypatch, hot, leaders, tile, tiles):
    """More near copies of a text than are compared each with each, some alike only through others; clusters of several tiles, and larger ones than tiles take."""
    monkeypatch.setattr(similar, "LEADERS", leaders)
    monkeypatch.setattr(similar, "TILE", tile)
    monkeypatch.setattr(similar, "MOST_TILES", tiles)
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(3):
        base = [r.choice(words) for _ in range(120)]
        for _ in range(40):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for k in range(40)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "One two"), (504, "one  TWO"), (505, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, links = plain_kept(rows)
    assert links > 300 and len(want) > 45
    assert ids(similar.drop_similar(docs, hot)) == want


def test_repeated_rows(spark):
    """A document whose row is repeated stays once and keeps its text; so does one of several copies without an id."""
    r = random.Random(8)
    a, b = (" ".join(r.choice("abcdefgh") * r.randint(1, 9) for _ in range(90)) for _ in range(2))
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "w"), (None, b, "y"), (None, b, "y"), (7, "short text here", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string").repartition(3)
    for drop in (similar.drop_similar, simhash.drop_near_duplicates):
        kept = drop(docs)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a, "w"), (None, b, "y"), (7, "short text here", "z")], key=str)
    assert sorted(x.text for x in suffix_dedup.drop_repeats(similar.drop_similar(docs)).collect()) == sorted([a, b, "short text here"])
