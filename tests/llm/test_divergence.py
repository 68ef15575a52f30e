"""The audit against plain Python over whole numbers, and its merge against a plain one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from airtally.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _audit(rows):
    by_group, holders = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        by_group[lang, source].update(words)
        holders[lang].update(set(words))
    out = []
    for (lang, source), counts in by_group.items():
        kept = {t for t, d in holders[lang].items() if d >= 3}
        same = {s: c for (l, s), c in by_group.items() if l == lang}

        def p(counted, term):
            return 1 + 10**9 * (counted[term] + 1) // (sum(counted[t] for t in kept) + len(kept))

        def f(a, b):
            return (a - b) * (a - b) // b

        pairs = [(sum(f(p(counts, t), p(c, t)) for t in kept), s) for s, c in same.items() if s != source]
        every = sum(same.values(), Counter())
        terms = [(f(p(counts, t), p(every, t)), t) for t in kept if counts[t] and p(counts, t) > p(every, t)]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < 200]
    return sorted(out)


def _rows(n, seed=5):
    pick = random.Random(seed)
    words = ["the", "The", "river", "é", "É", "日本", "a_b", "x1y", "it's", "\x7f", "​"] + [
        "w" + "".join(pick.choice("abcdefg") for _ in range(3)) for _ in range(60)]
    rows = []
    for _ in range(n):
        lang, source = pick.choice(["en", "en", "de", None, ""]), pick.choice(["s1", "s1", "s2", "s3", "é", None])
        rows.append((lang, source, " ".join(pick.choice(words) for _ in range(pick.randint(0, 25)))))
    return rows + [("en", "s4", None), ("fr", "s1", "lone words"), ("fr", "s2", ""), ("pt", "s9", "um um um"), ("pt", "s9", "um"),
                   ("pt", "s9", "um " * 3000)] + rows[:3]


def test_audit(spark, monkeypatch):
    rows = _rows(250)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS n", "2 AS id", "'b' AS base")
    wanted = _audit(rows)
    assert sorted(map(tuple, divergence.audit(docs.repartition(4)).collect())) == wanted
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 8)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == wanted
    assert {r[:2] for r in wanted} >= {("", ""), ("en", "s4"), ("fr", "s1")}
    assert divergence.audit(docs.limit(0)).collect() == []


def test_tasks_hand_on_early(spark, monkeypatch):
    docs = spark.createDataFrame(_rows(60), "lang string, source string, text string")
    whole = sorted(map(tuple, divergence.counted(docs).collect()))
    monkeypatch.setattr(divergence, "HELD", 3)
    assert sorted(map(tuple, divergence.counted(docs).collect())) == whole


def test_galloping_merge():
    random_ = np.random.default_rng(3)
    for sizes in ((0, 0), (0, 5), (3, 4000), (5000, 5000), (2500, 90), (1, 1)):
        a, b = (np.sort(random_.choice(9000, n, replace=False)).astype(np.int64) for n in sizes)
        in_a, in_b = divergence.intersection(a, b)
        assert a[in_a].tolist() == b[in_b].tolist() == np.intersect1d(a, b).tolist()
        counts = [random_.integers(1, 50, n) for n in sizes]
        seen, there, back = divergence.merged(a, counts[0], 10**15, b, counts[1], 777_777)
        known = [dict(zip(x.tolist(), c.tolist())) for x, c in zip((a, b), counts)]
        terms = set(known[0]) | set(known[1])
        p, q = ({t: 1 + 10**9 * (k.get(t, 0) + 1) // base for t in terms} for k, base in zip(known, (10**15, 777_777)))
        assert seen == len(terms)
        assert there == sum((p[t] - q[t])**2 // q[t] for t in terms) and back == sum((p[t] - q[t])**2 // p[t] for t in terms)


def test_large_counts_are_exact():
    counts = np.array([0, 1, 10**13, 8 * 10**15 - 1], np.int64)
    assert divergence.shares(counts, 8 * 10**15).tolist() == [1 + 10**9 * (int(c) + 1) // (8 * 10**15) for c in counts]
