"""Models on text: held-out accuracy, folds, odd inputs."""

import zlib

import numpy as np
import pytest

from airtally.llm import language, quality, toxicity

GOOD = "the of and river stone light water tree house road field north wind".split()
BAD = ["idiot", "scum"]


def _rows(n):
    """Plain texts; every fourth holds a toxic word, every fifth is shouted symbols."""
    order = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        words = list(order.choice(GOOD, 40))
        toxic, junk = int(i % 4 == 0), int(i % 5 == 0)
        if toxic:
            words[7] = str(order.choice(BAD))
        if junk:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, 1 - junk, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = _rows(400)
    odd = [(None, "idiot"), (1000, None), (1001, ""), (1002, "the river " * 40_000), (3, docs[3][1])]
    return (spark.createDataFrame(docs + odd, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS label"),
            spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (2000, 0, 1), (1, None, None)],
                                  "doc_id long, quality int, toxic int"), len(docs) + len(odd))


@pytest.mark.parametrize("operator, column, at", [(toxicity.toxicity, 2, 0.5), (quality.quality, 1, 0.3)])
def test_scores(tables, operator, column, at):
    docs, labels, n = tables
    rows = operator(docs, labels).collect()
    truth = {row[0]: row[column] for row in _rows(400)[1]}
    assert len(rows) == n
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= at) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_no_labels_and_empty(tables, operator):
    docs, labels, n = tables
    assert {r.score for r in operator(docs, labels.limit(0)).collect()} == {0.5}
    assert operator(docs.limit(0), labels).collect() == []


def test_quality_score_is_the_models_output():
    """The stored differences give what vectors, mean and softmax give."""
    docs, labels = _rows(60)
    model = quality.fit([t for _, t in docs], np.array([q for _, q, _ in labels]))
    text = docs[0][1]
    assert model.score(text) == pytest.approx(
        1 / (1 + np.exp(-(model.bias + np.mean([model.logits[b] for b in quality.buckets(text)])))))


TEXTS = {"xx": "Kato neka loru kanemo pilatu reko", "yy": "Wzgr prust krfnt schtrm pflog ngrt", "zz": "éàè çûô êîœ ùëï àçé ôûê"}


def test_language(spark):
    order = np.random.default_rng(1)
    rows = [(i, " ".join(order.permutation(TEXTS[lang].split() * 4)), lang)
            for i, lang in enumerate(list(TEXTS) * 40)]
    odd = [(500, None, "xx"), (501, "12 34 !!", "yy"), (502, "", None), (None, TEXTS["xx"], None), (503, TEXTS["zz"] * 50_000, None)]
    docs = spark.createDataFrame(rows + odd + rows[:2], "doc_id long, text string, lang string").selectExpr("*", "'s' AS score")
    found = language.identify(docs).collect()
    assert len(found) == len(rows) + len(odd) + 2
    known = {i: lang for i, _, lang in rows} | {503: "zz", None: "xx"}
    assert all(r.lang_pred == known[r.doc_id] and 0 < r.score <= 1 for r in found if r.doc_id in known)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in found if r.doc_id in (500, 501, 502))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert language.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", docs["lang"].substr(100, 1)).where("false")).collect()} == set()


def _same(one, other):
    return one is other is None or all(np.array_equal(a, b) for a, b in zip(one, other, strict=True))


def _bundle_plain(text):
    """Bound letter vectors added up by the definition, one trigram at a time."""
    letters = [c.lower()[0] if c.isalpha() else "" for c in f" {text} "]
    letters = [c for i, c in enumerate(letters) if c or i == 0 or letters[i - 1]]
    vectors = [language.letter_vector(ord(c) if c else 0).astype(int) for c in letters]
    return sum((np.roll(a, 2) * np.roll(b, 1) * c for a, b, c in zip(vectors, vectors[1:], vectors[2:])),
               np.zeros(language.DIMENSIONS, int))


@pytest.mark.parametrize("known", [1 << 15, 3])
def test_bundle_is_the_sum_of_bound_letters(monkeypatch, known):
    monkeypatch.setattr(language, "_KNOWN", known)
    monkeypatch.setattr(language, "_BOUND", 5)
    language._vectors.cache_clear()
    for text in ["  aBc!", "a", "вода и ВОДА", "ñandú 水曜日 θάλασσα ם", "kato neka " * 30, "x1y2z3"]:
        assert np.array_equal(language.bundle(language.trigrams(text)), _bundle_plain(text))
    language._vectors.cache_clear()
    assert language.trigrams("12 !") is None
    codes = [ord(c) for c in "вβاеñбтθם"]
    assert len({language.letter_vector(c).tobytes() for c in codes}) == len(codes)


def test_cosines_equal_plain_sums(spark):
    texts = {"ru": "вода течёт в реке", "el": "το νερό τρέχει", "he": "המים זורמים בנהר", "es": "el agua corre por el río"}
    rows = [(i, " ".join(texts[lang].split()[k % 3:]) + " " + texts[lang], lang)
            for i, (lang, k) in enumerate([(lang, k) for k in range(8) for lang in texts])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    learned = {lang: sum(_bundle_plain(t) for i, t, l in rows if l == lang and zlib.crc32(str(i).encode()) % 4 != 2)
               for lang in texts}
    for i, text, lang in rows:
        one = _bundle_plain(text)
        near = {name: one @ v / np.linalg.norm(one) / np.linalg.norm(v) for name, v in learned.items()}
        assert found[i].lang_pred == max(sorted(near), key=near.get) == lang
        assert found[i].score == pytest.approx(near[lang], abs=1e-5)


def _hashed_plain(codes, n, bits):
    """Feature number of each n-gram of code points by the definition, in whole numbers."""
    m, wrap = [int(x) for x in toxicity._MULTIPLIERS], (1 << 64) - 1
    out = []
    for i in range(len(codes) - n + 1):
        total = sum(c * m[k] for k, c in enumerate(codes[i:i + n])) & wrap
        out.append((((total ^ (total >> 29)) * m[4]) & wrap) >> (64 - bits))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 11, 1])
def test_toxicity_equals_plain_definition(monkeypatch, piece):
    docs, labels = _rows(80)
    truth = np.array([t for _, _, t in labels])
    model = toxicity.fit([text for _, text in docs], truth)
    monkeypatch.setattr(toxicity.common, "PIECE", piece)
    for text in [docs[0][1], docs[5][1], "", "a", "Ab İΣ ς idiot" * 7]:
        codes = [ord(c) for c in f" {text.lower()} "]
        found = {x for n in toxicity.LENGTHS for x in _hashed_plain(codes, n, toxicity.BITS)}
        assert found == set(toxicity.ngrams(text).tolist())
        wanted = 1 / (1 + np.exp(-(model.bias + sum(model.weights[x] for x in sorted(found)))))
        assert model.score(text) == pytest.approx(wanted)


def test_toxicity_ratios_equal_plain_counts():
    docs, labels = _rows(60)
    features, truth = [toxicity.ngrams(text) for _, text in docs], np.array([t for _, _, t in labels])
    found = toxicity.ratios(features, truth)
    for x in sorted({int(x) for f in features for x in f}):
        inside = [sum(x in f for f, y in zip(map(set, features), truth) if y == c) for c in (0, 1)]
        n, share = sum(inside), truth.mean()
        clear = abs(inside[1] - n * share) >= toxicity.CLEAR * np.sqrt(n * share * (1 - share))
        rates = [(1 + inside[c]) / (1 + (truth == c).sum()) for c in (0, 1)]
        assert found[x] == pytest.approx(np.log(rates[1] / rates[0]) if clear else 0.0)


@pytest.mark.parametrize("piece", [11, 3, 1])
def test_long_text_is_read_whole(monkeypatch, piece):
    texts = ["ab cd é" * 50, "word" * 30, "a\tb\n c  ", "x " + "y" * 40 + " é🙂 z", "", " "]
    whole = [(language.trigrams(text), np.sort(quality.buckets(text)), toxicity.ngrams(text)) for text in texts]
    monkeypatch.setattr(language.common, "PIECE", piece)
    for text, (letters, grams, features) in zip(texts, whole):
        assert _same(language.trigrams(text), letters)
        assert np.array_equal(np.sort(quality.buckets(text)), grams)
        assert np.array_equal(toxicity.ngrams(text), features)
