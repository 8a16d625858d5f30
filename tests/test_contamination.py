"""Matches with evaluation items against a plain version, on nulls, repeats, short and common items and long texts."""

import random
import re
from collections import Counter

import pytest

from veritrail.operators import contamination

WORD = re.compile(contamination.WORD)


def plain(text, items, n, most):
    """Maximal stretches shared with an item that hold a rare n-gram."""
    distinct = {}
    for item_id, t in items:
        w = tuple(WORD.findall((t or "").lower()))
        if w and (w not in distinct or item_id < distinct[w]):
            distinct[w] = item_id
    grams = Counter((min(n, len(w)), w[i : i + min(n, len(w))]) for w in distinct for i in range(len(w) - min(n, len(w)) + 1))
    d = WORD.findall((text or "").lower())
    out = set()
    for w, item_id in distinct.items():
        size = min(n, len(w))
        same = {(p, q) for p in range(len(d) - size + 1) for q in range(len(w) - size + 1) if tuple(d[p : p + size]) == w[q : q + size]}
        for p, q in same:
            if (p - 1, q - 1) not in same:
                k = 0
                while (p + k + 1, q + k + 1) in same:
                    k += 1
                if any(grams[size, w[q + j : q + j + size]] <= most for j in range(k + 1)):
                    out.add((item_id, p, p + k + size, q))
    return out


def cut(text, found):
    gone = {i for _, a, b, _ in found for i in range(a, b)}
    parts = re.findall(contamination.SPACED_WORD, text)
    return "".join(x for i, x in enumerate(parts) if i not in gone) + re.search(r"[\x20\x09-\x0D]*\Z", text).group()


@pytest.mark.parametrize(("n", "most"), [(5, 64), (4, 1), (2, 3)])
def test_matches(spark, n, most, monkeypatch):
    r = random.Random(n)
    some = lambda k: " ".join(r.choice("abcdefgh") for _ in range(k))
    common = "every item says this line"
    items = [(k, f"{some(r.randint(2, 14))} {common} {some(3)}") for k in range(12)] + [(90, "Just TWO"), (91, items_text := some(9)), (92, items_text), (93, None), (94, " \n"), (None, "x y z x y z x y z x y z")]
    docs = [(k, f"{some(20)}\n\n {items[k % 12][1]}\t{some(5)} ") for k in range(10)]
    docs += [(20, None), (21, ""), (22, items_text.upper()), (22, items_text.upper()), (23, f"just two {common}"), (24, "x y z " * 300), (None, " just  two\n"), (25, some(3000))]
    rows = [(d, t, "mine", "k") for d, t in docs]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string, cleaned string, key string"), spark.createDataFrame(items, "item_id long, text string")
    for sent in (contamination.MOST_SENT, 3):
        monkeypatch.setattr(contamination, "MOST_SENT", sent)
        got = contamination.decontaminate(df, bench, n, most).collect()
        want = []
        for d, t in docs:
            found = plain(t, items, n, most)
            spans = []
            for item, a, b, _ in sorted(found, key=lambda x: (x[1], x[2])):
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]), spans[-1][2] | {item})
                else:
                    spans.append((a, b, {item}))
            want.append((d, t, "k", tuple((a, b, tuple(sorted((x for x in i if x is not None)))) for a, b, i in spans), t if not found else cut(t, found)))
        assert Counter((x.doc_id, x.text, x.key, tuple((s.start, s.end, tuple(s["items"])) for s in x.removed), x.cleaned) for x in got) == Counter(want)
    assert any(x.removed for x in got)


def test_empty(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination.decontaminate(docs, items.limit(0)).first().cleaned == "a b c"
    assert contamination.decontaminate(docs.limit(0), items).count() == 0
    assert contamination.decontaminate(docs, items).first().cleaned == ""
