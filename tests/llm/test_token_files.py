"""Token files against the library itself, and random access against the plain id stream."""

import random
import zlib

import numpy as np
import pytest

from airtally.llm import chunks, queries, token_files
from airtally.session import new_folder

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def _ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def _odd_texts(n, seed=7):
    pick = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "a", "word", "don't", "'s", "12", "½", "é", "日本", "🙂",
             "!", "<|endoftext|>", "_", "́", "​", "x" * 90]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 14))) for _ in range(n)]


def test_chunks_encode_as_whole_texts(library):
    texts = _odd_texts(3000) + ["", " ", "  a", " a", "a ", "a \n b", "a\n \nb", "a\n b", "! !", "a\n <|endoftext|> b", "a\t <|endoftext|>", "word " * 3000, "y" * 5000]
    encoder = token_files.LibraryEncoder(PATH)
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert [ids.tolist() for ids in encoder.encode(part)] == [_ids(library, text)[:-1] for text in part]
    encoder.chunks.forget()
    assert encoder.encode(["a word again"])[0].tolist() == _ids(library, "a word again")[:-1]
    assert chunks.cut("a  b") is None and chunks.cut("a b\nc") == ["a", "b\nc"]


def test_files(spark, library):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _files(spark, library)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _files(spark, library):
    rows = [(i * 7 % 400, text) for i, text in enumerate(_odd_texts(400, 3))]
    rows += [(400, None), (401, "long text " * 4000), (402, ""), (5, "again"), (5, "again"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS start", "1 AS n_tokens", "2 AS part")
    folder = new_folder(spark, "token-test")
    files = token_files.written_files(docs.repartition(5), folder, PATH, length=16, sequences=4).orderBy("part").collect()
    assert sum(f.documents for f in files) == len(rows) and len(files) > 1
    start, seen = 0, []
    for f in files:
        assert f.start == start
        sequences = token_files.Sequences(f.data)
        parts = [sequences.sequence(i) for i in range(len(sequences))]
        assert all(not ids.flags.owndata and len(ids) == 16 for ids, _ in parts)
        masks = np.concatenate([np.array(mask.to_pylist()) for _, mask in parts])
        assert masks[:f.tokens].all() and not masks[f.tokens:].any() and len(masks) - f.tokens < 16
        stream = np.concatenate([ids for ids, _ in parts])[:f.tokens].tolist()
        for batch in token_files.documents_in(f["index"]):
            for row in batch.to_pylist():
                ids = np.concatenate(list(sequences.span(row["start"], row["n_tokens"]))).tolist()
                assert ids == stream[row["start"]:row["start"] + row["n_tokens"]]
                seen.append((row["doc_id"], ids))
        start += f.tokens
    assert [i for i, _ in seen] == sorted((i for i, _ in rows if i is not None)) + [None, None]
    assert sorted(map(repr, seen)) == sorted(repr((i, _ids(library, text))) for i, text in rows)

    found = token_files.checksums(docs, new_folder(spark, "token-test"), PATH).orderBy("start").collect()
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found[:-1]]]).tolist()
    wanted = {repr((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))) for i, ids in seen}
    assert {repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in found} == wanted


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = token_files.checksums(docs, new_folder(spark, "token-test"), PATH)
    assert found.collect() == [] and found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_own_encoder_by_chunk_as_whole_texts(library):
    """The automaton's encoder shares the cutting into chunks: the same odd texts, the same ids."""
    from airtally.llm import bpe

    words = bpe.vocabulary(PATH)
    known = bpe.Lexicon(bpe.Lexicon.compiled((w, words.merge(w)) for w in sorted([b" word", b"word", b" ", b"\n", b"!"])))
    encoder = bpe.Encoder(words, known)
    texts = _odd_texts(2000, 9) + ["", " ", "a\n <|endoftext|> b", "a \n b", "z" * 3000, "  lead", "trail  "]
    for at in range(0, len(texts), 200):
        part = texts[at:at + 200]
        assert [ids.tolist() for ids in encoder.encode(part)] == [_ids(library, text)[:-1] for text in part]
    for text in part:
        ids = np.array(_ids(library, text), np.int64)
        assert bpe.decode(ids, PATH) == library.decode(ids.tolist(), skip_special_tokens=False)
