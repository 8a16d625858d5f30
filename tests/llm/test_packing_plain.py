"""Packing of a whole table against a plain best-fit with every set of capacities, and texts of a million words."""

import random
from itertools import combinations

import pytest

from veritrail.llm import packing, quality, simhash


def plain_cost(sizes, allowed, final):
    """Open bins are looked through one by one."""
    left = sorted(sizes, reverse=True)
    bins = []
    for k, size in enumerate(left):
        fitting = [b for b in bins if b[1] >= size]
        if fitting:
            best = min(fitting, key=lambda b: b[1])
        else:
            worth = lambda c: packing.cost(c) / max(1, min(c, size + sum(x for x in left[k + 1 :] if x <= c - size)))  # noqa: B023, E731
            best = [0, min((c for c in allowed if c >= size), key=worth)]
            bins.append(best)
        best[0] += size
        best[1] -= size
    return sum(packing.cost(min(c for c in final if c >= used)) for used, _ in bins)


@pytest.mark.parametrize("capacities", [packing.CAPACITIES, (50, 128), (300,)])
def test_documents(spark, capacities):
    r = random.Random(len(capacities))
    counts = [r.choice([0, 1, 7, 49, 50, 51, 127, 128, 129, 300, 511, 513, 2000, 4096, 9000]) + r.randint(0, 3) for _ in range(150)]
    docs = spark.createDataFrame([(k, " ".join(["w"] * n) if n else None) for k, n in enumerate(counts)] + [(1, "w w")] * 3, "doc_id long, text string").repartition(3)
    most, counts = max(capacities), [*counts, 2, 2, 2]
    pieces = [min(most, n - k * most) for n in counts for k in range(max(1, -(-n // most)))]
    got = packing.pack_documents(docs, capacities).collect()
    assert sorted(p.n_words for p in got) == sorted(pieces)
    bins = {p.bin_id: p.bin_capacity for p in got}
    sets = [s for n in range(1, len(capacities) + 1) for s in combinations(sorted(capacities), n) if s[-1] >= max(pieces)]
    assert sum(map(packing.cost, bins.values())) == pytest.approx(min(plain_cost(pieces, s, sorted(capacities)) for s in sets))


def test_very_long_texts(spark):
    """Texts of some hundred thousand words take their time and no more."""
    long = " ".join(f"w{k % 977}" for k in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short text of a few words, nine in all")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    report = {r.doc_id: r.n_words for r in quality.quality_report(docs, labels).collect()}
    assert report == {1: 300_000, 2: 300_001, 3: 9}
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}
    packed = packing.pack_documents(docs).collect()
    assert sum(p.n_words for p in packed) == 600_010
