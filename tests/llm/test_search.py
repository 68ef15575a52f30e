"""Block-Max MaxScore against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from airtally.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def _ranked(rows, items, top):
    docs = [(i, Counter(_terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * len(docs) // total
            score = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        scored.sort()
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def _corpus(n, seed=11):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "é", "日本", "a_b", "X-1", "the", "The"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = [(pick.randrange(10 * n), " ".join(pick.choices(words, weights, k=pick.choice((0, 1, 5, 40, 200))))) for _ in range(n)]
    return rows + rows[:5] + [(None, "w1 w2"), (None, "w1 w2"), (3, None), (4, ""), (5, "w0 " * 9000)]


@pytest.mark.parametrize("top", [5, 50])
def test_ranked(spark, monkeypatch, top):
    monkeypatch.setattr(search, "WINDOW", 32)
    monkeypatch.setattr(search, "BLOCK", 8)
    rows = _corpus(700)
    pick = random.Random(2)
    items = [(k, " ".join(t for _, t in pick.sample(rows, 2) if t)[:200]) for k in range(25)]
    items += [(90, None), (91, "absent zzz"), (92, "w0"), (92, "w7 w9"), (93, "w1 w1 w1"), (None, "w3 w4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'t' AS term", "1 AS shard", "2 AS df")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'t' AS term", "1 AS score")
    wanted = _ranked(rows, items, top)
    n = search.totals(docs)
    for parts, docs_of, slices in ((1, 200, 512), (6, 8192, 4)):
        monkeypatch.setattr(search, "SHARD_DOCS", docs_of)
        monkeypatch.setattr(search, "SLICE_ITEMS", slices)
        lists = search.index(docs.repartition(parts), *n)
        assert sorted(map(tuple, search.search(lists, asked, *n, top).collect()), key=repr) == wanted
    assert search.ranked(docs, asked.limit(0)).collect() == [] == search.ranked(docs.limit(0), asked).collect()


def test_blocks_stay_packed(monkeypatch):
    """A rare strong term leaves most blocks of a frequent weak one packed, with the same answer."""
    monkeypatch.setattr(search, "BLOCK", 64)
    pick = random.Random(4)
    builder = search.Builder(20_000, 200_000)
    for i in range(20_000):
        builder.add(i, [b"the"] * pick.randint(1, 3) + [b"rare"] * (i % 900 == 0) * 3 + [b"x"] * pick.randint(1, 12))
    rows = [row for batch in builder.rows(0) for row in batch.to_pylist()]
    m = search.spread(np.frombuffer(rows[0]["data"], np.int64), 20_000, 200_000)
    lists = {r["term"]: search.PostingList({"rare": 6000, "the": 3}.get(r["term"], 1), r["df"], r["best"], r["blocks"], r["data"], m)
             for r in rows[1:]}
    docs, scores = search.best_documents([lists["the"], lists["rare"]], 20_000, 10)
    assert lists["the"].have.mean() < 0.4 and lists["rare"].have.all()
    for one in lists.values():
        one.need(np.arange(len(one.have)))
    total = np.zeros(20_000, np.int64)
    for term in ("the", "rare"):
        total[lists[term].doc] += lists[term].share
    order = np.lexsort((np.arange(20_000), -total))[:10]
    assert docs.tolist() == order.tolist() and scores.tolist() == total[order].tolist()


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1])
    data, starts = search.packed(values)
    assert search.unpacked(data).tolist() == values.tolist() and starts[:4].tolist() == [0, 1, 2, 3]
    assert search.unpacked(data[:0]).tolist() == []
