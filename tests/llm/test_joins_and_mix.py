"""Jaccard join, top-k search, BPE, mixing and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from airtally.llm import bpe, jaccard, mixing, queries, topk

tokenizers = pytest.importorskip("tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    words = WORD.findall((text or "").encode().lower().decode())
    return {tuple(words[i:i + 4]) for i in range(max(len(words) - 3, 1))} if words else set()


def _components(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, _set(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b) or i == j:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i) if s else i) for i, s in sets)


def _near_copies(n, seed=4):
    pick = random.Random(seed)
    vocabulary = [a + b for a in "abcdefgh" for b in "xyzuvw"]
    bases = [[pick.choice(vocabulary) for _ in range(pick.choice((5, 30, 90)))] for _ in range(6)]
    passage = [pick.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(n):
        words = list(pick.choice(bases))
        for _ in range(pick.choice((0, 0, 1, 2, 4))):
            words[pick.randrange(len(words))] = pick.choice(vocabulary).upper()
        rows.append((1000 - i, " ".join(words + passage * (i % 9 == 0))))
    return rows + [(i, " ".join(pick.choice(vocabulary) for _ in range(60))) for i in range(20)]


@pytest.mark.parametrize("frequent", [32, 2])
def test_components(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = _near_copies(150) + [(2000, None), (2001, ""), (2002, "One"), (2003, "oNE"), (2002, "One")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "'t' AS token")
    found = sorted(tuple(r) for r in jaccard.components(docs).collect())
    assert found == _components(rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in found})


def test_pipeline_links_five_word_copies_from_080(spark):
    """Copies with a few words changed or appended, many between 0.80 and 0.85, against brute force."""
    def grams(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}

    pick, rows = random.Random(8), []
    for base in range(30):
        words = [f"w{pick.randint(0, 400)}" for _ in range(100)]
        rows.append((2 * base, " ".join(words)))
        for at in pick.sample(range(5, 95), base % 3):
            words[at] = "changed"
        rows.append((2 * base + 1, " ".join(words + [f"more{k}" for k in range((0, 8, 19, 23, 26)[base % 5])])))
    sets, group = [grams(t) for _, t in rows], list(range(len(rows)))
    similar = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in range(len(rows)) for i in range(j)}
    for (i, j), share in similar.items():
        if share >= 0.8:
            group = [group[i] if g == group[j] else g for g in group]
    assert sum(0.8 <= share < 0.85 for share in similar.values()) >= 5 and any(0.7 < share < 0.8 for share in similar.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group))


def test_components_of_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (None, "x"), (7, "q"), (7, "z z")], "doc_id long, text string")
    assert sorted(map(str, map(tuple, jaccard.components(docs).collect()))) == sorted(map(str, [
        (None, 2, 5), (5, 2, 5), (None, 1, None), (7, 1, 7), (7, 1, 7)]))
    assert jaccard.components(docs.limit(0)).collect() == []


def test_search_equals_all_products():
    order = np.random.default_rng(0)
    for trial in range(40):
        n, m, d = order.integers(0, 250), order.integers(0, 40), order.integers(1, 6)
        rows, asked = order.integers(-4, 5, (n, d)).astype(float), order.integers(-4, 5, (m, d)).astype(float)
        if trial % 3 == 0:
            rows[n // 2:] = rows[:1]
        row_ids, ids = order.permutation(1000)[:n], order.permutation(1000)[:m]
        got, scores = topk.search(asked, ids, rows, row_ids, 5)
        for i in range(m):
            wanted = sorted((-int(asked[i] @ rows[j]), int(row_ids[j])) for j in range(n) if row_ids[j] != ids[i])[:5]
            assert [(-int(s), int(r)) for r, s in zip(got[i], scores[i]) if r >= 0] == wanted


def test_nearest(spark):
    order = np.random.default_rng(1)
    rows = [(i, [float(x) for x in order.normal(size=4)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (None, [1.0] * 4),
             (304, []), (305, [2.0]), rows[10]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score")
    used = [(i, np.floor(256.0 * np.array((list(np.float32(v)) + [0.0] * 4)[:4], float))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    wanted = []
    for i, v in used[:300:50]:
        best = sorted((-int(v @ w), j) for j, w in used if j != i)[:5]
        wanted += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    for blocks in ({}, {"row_block": 40, "query_block": 2}):
        found = topk.nearest(vectors, topk.F.col("vec_id") % 50 == 0, 5, **blocks).collect()
        assert sorted(tuple(r) for r in found if r.query_id < 300) == sorted(wanted)
    assert topk.nearest(vectors.limit(0), topk.F.col("vec_id") % 50 == 0).collect() == []


PIECES = ["<|endoftext|>", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ñ", "a", "ab", " the", "'s", "'ll", "123", "½",
          "中文", "🙂", "é", "!!", "$%", "​", "\x00", "ſ", "<|endof", "x" * 150, "ab" * 90]


def test_bpe_equals_the_library(spark):
    path = queries.vocabulary_path()
    pick = random.Random(2)
    texts = ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 12))) for _ in range(800)] + ["the end " * 20_000]
    docs = spark.createDataFrame([*enumerate(texts), (None, None), (3, texts[3])], "doc_id long, text string").selectExpr("*", "1 AS ids")
    reference = tokenizers.Tokenizer.from_file(path)
    data = bpe.lexicon(docs, path)
    encoded = bpe.encode(docs, path, data)
    back = {(r.doc_id): r.text for r in bpe.decoded(encoded, path).collect()}
    for r in encoded.collect():
        ids = reference.encode(texts[r.doc_id] if r.doc_id is not None else "", add_special_tokens=False).ids
        assert r.ids == ids and back[r.doc_id] == reference.decode(ids, skip_special_tokens=False)
    found = bpe.digest(docs, path, data).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        ids = reference.encode(texts[r.doc_id] if r.doc_id is not None else "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digest(docs.limit(0), path, bpe.lexicon(docs.limit(0), path)).collect() == []


def test_lexicon_is_minimal_and_numbers_its_words():
    words = sorted({a + b for a in (b"un", b"re", b"in") for b in (b"do", b"tie", b"fold")} | {b"do"})
    known = bpe.Lexicon(bpe.Lexicon.compiled((w, [i]) for i, w in enumerate(words)))
    assert known.numbers([*words, b"und", b"zz", b"undone"]).tolist() == [*range(len(words)), -1, -1, -1]
    # The three prefixes share one set of endings.
    assert len(known.final) < sum(map(len, words)) / 2


def _targets(sizes):
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in capped]
        rest, weights = total - sum(capped.values()), sum(weight[s] for s in free)
        new = {s: 3.0 * sizes[s] for s in free if weight[s] / weights * rest > 3 * sizes[s]}
        if not new:
            return {s: capped.get(s, weight[s] / max(weights, 1) * rest) for s in sizes}
        capped.update(new)


def test_mixing(spark):
    pick = random.Random(6)
    rows = [(i, " ".join(["w"] * pick.choice((1, 3, 10, 40, 200))), pick.choice(["a"] * 8 + ["b", "c", "d"])) for i in range(900)]
    rows += [(2000, "x y z", "tiny"), (2001, None, "a"), (2002, " ", "b"), (None, "p q", None), (2003, "r", None), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2.0 AS target")
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))
    source = {i: s for i, _, s in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.size == len((dict((i, t) for i, t, _ in rows)[r.doc_id] or "").split()) and 0 <= r.taken <= 3 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    targets = _targets(sizes)
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]], rel=1e-9)
    assert all(abs(taken[s] - targets[s]) <= max(3, 0.03 * targets[s]) for s in sizes)
    assert mixing.mixed(docs.limit(0)).collect() == []
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert set(Counter(r.doc_id for r in copies.collect()).values()) <= {1, 2, 3, 6, 9}


def test_mix_is_the_same_for_any_number_of_slots(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 4 == 0]) for i in range(400)], "doc_id long, text string, source string")
    few = sorted(map(tuple, mixing.mixed(docs).collect()))
    monkeypatch.setattr(mixing, "SLOT_ROWS", 1)
    assert sorted(map(tuple, mixing.mixed(docs).collect())) == few


def test_rates_are_tilted_by_size(spark):
    """Each rate is exp(dual * size), cut at the limit."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "ab"[i % 5 == 0]) for i in range(300)], "doc_id long, text string, source string")
    by_source = defaultdict(dict)
    for r in mixing.plan(docs).collect():
        by_source[r.source][r.size] = r.rate
    for rates in by_source.values():
        slopes = [np.log(rate) / size for size, rate in rates.items() if rate < 3]
        assert slopes == pytest.approx(slopes[:1] * len(slopes))


def test_pipeline(spark):
    pick = random.Random(9)
    words = "river stone light water tree house road field north wind".split()
    clean = [" ".join(pick.choice(words) + str(pick.randint(0, 99)) for _ in range(70)) for _ in range(24)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(clean)]
    rows += [(100, clean[3], "en", "s0", 1), (101, "short text", "en", "s1", 1), (102, " ".join(["%%%"] * 90), "en", "s0", 1),
             (103, clean[5] + " token=abcdefgh", "en", "s1", 1), (104, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages, seen = dict(corpus_pipeline.STAGES), docs
    for name in list(stages)[:4]:
        seen = mixing.written(stages[name](spark, seen, "/root/testdata/sf0.001"), name)
        assert seen.columns == docs.columns
        ids = {r.doc_id for r in seen.collect()}
        assert ids.isdisjoint({101, 102, 104})
        if name == "quality_rules":
            assert ids == {*range(24), 100, 103}
        elif name != "mix_sources":
            assert ids == {*range(24)}
    reference = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    last = stages["encode_text"](spark, seen, "").collect()
    copies = Counter((r.doc_id, r.text) for r in seen.collect())
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in seen.collect()) and sum(copies.values()) == len(last)
    text = {i: t for i, t in copies}
    assert all(r.n_tokens == len(reference.encode(text[r.doc_id]).ids) for r in last)


def test_rows_without_an_id_link_too(spark):
    """A text without an id may hold two documents together; copies without ids leave one."""
    words = [f"w{k}" for k in range(200)]
    middle, left, right = list(words), list(words), list(words)
    left[20], left[60], right[120], right[160] = "a", "b", "c", "d"
    texts = {k: " ".join(w) for k, w in (("left", left), ("middle", middle), ("right", right))}
    sets = {k: _set(t) for k, t in texts.items()}
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets}
    assert share["left", "middle"] >= 0.85 <= share["middle", "right"] and share["left", "right"] < 0.86
    lone = " ".join(f"q{k}" for k in range(80))
    rows = [(1, texts["left"]), (None, texts["middle"]), (3, texts["right"]), (None, lone), (None, lone), (None, lone + " end"),
            (None, None), (None, ""), (8, "other words of its own"), (None, "other words of its own"), (8, "other words of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "map('k', text) AS group", "1 AS id", "'x' AS row", "2 AS set_id", "3 AS n")
    found = jaccard.components(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == sorted(
        [(1, 1), (None, 1), (3, 1), *[(None, None)] * 5, (8, 8), (8, 8), (None, 8)], key=repr)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, texts["left"]), (None, lone + " end"), (None, None), (None, ""), (8, "other words of its own")], key=repr)
    assert jaccard.one_of_each(docs.limit(0)).collect() == []


def test_mixed_words_are_those_planned(spark):
    """Rows without ids, and rows that the plan cannot tell apart, are taken as often as planned."""
    pick = random.Random(21)
    rows = [(None if i % 3 else i, " ".join(pick.choice("abcdef") for _ in range(pick.randint(0, 6))), pick.choice(["s", "t", "u", None]))
            for i in range(600)]
    rows += [(None, "one two three", "s")] * 40 + [(7, "same row", "t")] * 30 + [(900, None, "s"), (901, "word " * 5000, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "map('m', 1) AS copies", "2 AS key", "3 AS number", "4 AS row", "5 AS size")
    words, wanted, taken = lambda text: len(WORD.findall(text or "")), Counter(), Counter()
    for r in mixing.plan(docs).collect():
        wanted[r.source] += r.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = mixed.collect()
    for r in found:
        taken[r.source] += words(r.text)
    assert taken == wanted and all(words(r.text) for r in found)
    often = Counter((r.doc_id, r.text, r.source) for r in found)
    here = Counter((i, t, s) for i, t, s in rows)
    assert all(n <= 3 * here[k] for k, n in often.items())
    assert mixing.mixed_documents(docs.limit(0)).collect() == []
