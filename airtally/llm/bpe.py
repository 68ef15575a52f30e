"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The frequent pre-tokens of the corpus are merged once and compiled into a minimal acyclic
automaton: words share prefixes and, as far as they are accepted alike, suffixes. Every arc
holds how many words come before it, so a walk adds up to the word's number, and that gives its ids.
The automaton is a dense table over the byte classes in use; workers map it into memory and
walk all new words of a batch at a time. Words outside the lexicon are merged
exactly, pair by pair in rank order. Texts are cut into chunks before spaces first, and each
different chunk is cut into pre-tokens and looked up once as long as it is remembered.

Encoding equals the vocabulary file's own library without added special tokens; text equal to
an added token becomes its id. Decoding joins the bytes of the ids and replaces invalid UTF-8.

Cases: null or empty text: no ids, decoded to the empty text; each input row gives one row,
repeated rows included; an empty table gives an empty lexicon and result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import chunks, common

#: Words a task proposes, and words the lexicon holds.
PROPOSED, LEXICON = 30_000, 50_000
_NO_MERGE = 1 << 62
_SPLIT = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


@dataclass(frozen=True)
class Vocabulary:
    """Merges of a byte-level BPE file. ``pairs``: left << 32 | right to rank << 32 | merged."""

    single: list[int]
    pairs: dict[int, int]
    pieces: list[bytes]
    added: dict[str, int]

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: always the lowest-ranked pair first, leftmost on a tie."""
        ids = [self.single[b] for b in word]
        if len(ids) > 100:
            return self._merge_long(ids)
        get = self.pairs.get
        found = [get(a << 32 | b, _NO_MERGE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != _NO_MERGE:
            i, merged = found.index(best), best & 0xFFFFFFFF
            ids[i:i + 2] = [merged]
            del found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 32 | merged, _NO_MERGE)
            if i < len(found):
                found[i] = get(merged << 32 | ids[i + 1], _NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for very long words."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j < len(ids) and (found := self.pairs.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (found, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            push(i, i + 1)
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = found & 0xFFFFFFFF, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            push(before[i], i)
            push(i, after[i])
        return [x for x in ids if x >= 0]


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    letters = _byte_letters()
    number = {letter: i for i, letter in enumerate(letters)}
    ids = read["model"]["vocab"]
    added = {token["content"]: token["id"] for token in read["added_tokens"]}
    pieces = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for text, i in ids.items():
        pieces[i] = bytes(number[c] for c in text)
    for text, i in added.items():
        pieces[i] = text.encode()
    pairs: dict[int, int] = {}
    for rank, merge in enumerate(read["model"]["merges"]):
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        pairs.setdefault(ids[left] << 32 | ids[right], rank << 32 | ids[left + right])
    return Vocabulary([ids[letter] for letter in letters], pairs, pieces, added)


def pretokens(text: str, words: Vocabulary) -> Iterator[list[str] | int]:
    """Lists of pre-tokens, and the ids of added tokens between them."""
    if not any(token in text for token in words.added):
        yield _SPLIT.findall(text)
        return
    parts = regex.split("(" + "|".join(map(regex.escape, sorted(words.added, key=len, reverse=True))) + ")", text)
    for i, part in enumerate(parts):
        if i % 2:
            yield words.added[part]
        elif part:
            yield _SPLIT.findall(part)


class Lexicon:
    """Minimal acyclic automaton over byte strings with an id list per string.

    ``step[state, class]`` is the next state (0: none, the start is 1), ``skip`` the number of
    words before that arc, ``final`` marks accepting states.
    """

    def __init__(self, data: bytes | mmap.mmap) -> None:
        sizes = np.frombuffer(data, np.int64, 4)
        states, classes, count, ids = map(int, sizes)
        at = 32
        take = {}
        for name, kind, n in (("classes", np.uint8, 256), ("final", np.uint8, states), ("step", np.int32, states * classes),
                              ("skip", np.int32, states * classes), ("starts", np.int32, count + 1),
                              ("ids", np.uint32, ids)):
            at = (at + 7) // 8 * 8
            take[name] = np.frombuffer(data, kind, n, at)
            at += n * np.dtype(kind).itemsize
        self.classes, self.final, self.starts, self.ids = (take[k] for k in ("classes", "final", "starts", "ids"))
        self.step, self.skip = take["step"].reshape(states, classes), take["skip"].reshape(states, classes)

    @staticmethod
    def compiled(words: Iterable[tuple[bytes, list[int]]]) -> bytes:
        """Build from strings sorted by bytes: finished suffixes are shared as they are left."""
        words = list(words)
        used = sorted({b for word, _ in words for b in word})
        classes = np.zeros(256, np.uint8)
        classes[used] = np.arange(1, len(used) + 1)
        registry: dict[tuple, int] = {}
        arcs: list[dict[int, int]] = [{}, {}]
        final: list[bool] = [False, False]
        counts: list[int] = [0, 0]
        open_arcs: list[list[tuple[int, int]]] = [[]]
        open_final = [False]

        def close() -> int:
            key = (open_final.pop(), tuple(open_arcs.pop()))
            if key not in registry:
                registry[key] = len(arcs)
                arcs.append(dict(key[1]))
                final.append(key[0])
                counts.append(key[0] + sum(counts[state] for _, state in key[1]))
            return registry[key]

        last = b""
        for word, _ in words:
            shared = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
            for i in range(len(last), shared, -1):
                state = close()
                open_arcs[-1].append((int(classes[last[i - 1]]), state))
            for _ in word[shared:]:
                open_arcs.append([])
                open_final.append(False)
            open_final[-1] = True
            last = word
        for i in range(len(last), 0, -1):
            state = close()
            open_arcs[-1].append((int(classes[last[i - 1]]), state))
        arcs[1], final[1] = dict(open_arcs[0]), open_final[0]
        step = np.zeros((len(arcs), len(used) + 1), np.int32)
        skip = np.zeros_like(step)
        for state, out in enumerate(arcs):
            before = int(final[state])
            for letter, to in out.items():
                step[state, letter], skip[state, letter] = to, before
                before += counts[to]
        lengths = [len(ids) for _, ids in words]
        parts = [classes, np.array(final, np.uint8), step, skip, np.cumsum([0, *lengths]).astype(np.int32),
                 np.array([i for _, ids in words for i in ids], np.uint32)]
        out = np.array([len(arcs), len(used) + 1, len(words), sum(lengths)], np.int64).tobytes()
        for part in parts:
            out += bytes(-len(out) % 8) + part.tobytes()
        return out

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1; all words walk in step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = self.classes[np.frombuffer(b"".join(words) + b"\0", np.uint8)]
        starts = np.cumsum(lengths) - lengths
        state, total = np.ones(len(words), np.int32), np.zeros(len(words), np.int64)
        walking = np.arange(len(words))
        for depth in range(int(lengths.max(initial=0))):
            walking = walking[(lengths[walking] > depth)]
            letter = data[starts[walking] + depth]
            to = self.step[state[walking], letter]
            total[walking] += self.skip[state[walking], letter]
            state[walking] = to
            walking = walking[to > 0]
            if not len(walking):
                break
        return np.where(self.final[state] > 0, total, -1)

    def packed(self, number: int) -> bytes:
        return self.ids[self.starts[number]:self.starts[number + 1]].tobytes()


def lexicon(docs: DataFrame, path: str, proposed: int = PROPOSED, size: int = LEXICON) -> bytes:
    """The compiled lexicon of the corpus' frequent pre-tokens.

    All texts are counted; each task hands on its most frequent words, so what is shuffled
    and collected has a fixed bound per task and in all. Which words are in decides speed
    only, never a result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counted = vocabulary(path), Counter()
        for batch in batches:
            for text in common.texts_of(batch):
                pieces = chunks.cut(text)
                # The first chunk of a text, without a space, is one of many.
                counted.update([" " + text] if pieces is None else pieces[1:])
            if len(counted) > 20 * proposed:
                counted = Counter(dict(counted.most_common(10 * proposed)))
        by_word: Counter = Counter()
        for chunk, n in counted.items():
            for part in pretokens(chunks.text_of(chunk), words):
                if not isinstance(part, int):
                    for word in part:
                        by_word[word] += n
        top = [(word, n) for word, n in by_word.most_common(proposed) if len(word) <= 40]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    top = (docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(size).select("word").collect())
    words = vocabulary(path)
    return Lexicon.compiled((word, words.merge(word)) for word in sorted(row["word"].encode() for row in top))


_mapped: dict[bytes, Lexicon] = {}


def _open(data: bytes) -> Lexicon:
    """The lexicon, mapped from a private file that vanishes with the worker."""
    if (key := hashlib.sha256(data).digest()) not in _mapped:
        _mapped.clear()
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            _mapped[key] = Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    return _mapped[key]


class Encoder:
    """Texts to ids as 32-bit numbers, each different chunk once."""

    def __init__(self, words: Vocabulary, known: Lexicon) -> None:
        self.words, self.known = words, known
        self.chunks = chunks.ByChunk(np.uint32, self._learn, lambda text: self._ids([text])[0], list(words.added))
        self.encode = self.chunks.encode

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts: their different words walk the lexicon together."""
        split = [list(pretokens(text, self.words)) for text in texts]
        new = list({word for parts in split for part in parts if not isinstance(part, int) for word in part})
        raw = [word.encode() for word in new]
        ids = {word: self.known.packed(number) if number >= 0 else np.array(self.words.merge(data), np.uint32).tobytes()
               for word, data, number in zip(new, raw, self.known.numbers(raw).tolist())}
        return [np.frombuffer(b"".join([x for part in parts for x in (
            [np.uint32(part).tobytes()] if isinstance(part, int) else map(ids.__getitem__, part))]), np.uint32) for parts in split]

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._ids(list(map(chunks.text_of, new)))
        return np.concatenate(found), np.array([len(ids) for ids in found])


@cache
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids one after another, where each id's begin and how many they are."""
    pieces = vocabulary(path).pieces
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode(ids: np.ndarray, path: str) -> str:
    data, starts, sizes = _pieces(path)
    length = sizes[ids]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts[ids] - ends + length, length) + np.arange(total)
    return data[places].tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, data: bytes) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    return _run(docs, path, data, "ids array<int>", lambda ids: (ids.view(np.int32).tolist(),))


def digest(docs: DataFrame, path: str, data: bytes) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    def row(ids: np.ndarray) -> tuple[int, str, str]:
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decode(ids, path).encode()).hexdigest()

    return _run(docs, path, data, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", row)


def _run(docs: DataFrame, path: str, data: bytes, columns: str, row: Callable[[np.ndarray], tuple]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(data)
    kinds = {"array<int>": pa.list_(pa.int32()), "bigint": pa.int64(), "string": pa.string()}
    fields = [pair.split(" ") for pair in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [row(ids) for ids in encoder.encode(common.texts_of(part))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array([r[i] for r in rows], kinds[kind])
                                              for i, (_, kind) in enumerate(fields)]],
                    ["doc_id", *[name for name, _ in fields]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {columns}")


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, data: bytes) -> Encoder:
    """The worker's encoder of a lexicon; it remembers chunks from task to task."""
    known = _open(data)
    if (path, id(known)) not in _encoders:
        _encoders.clear()
        _encoders[path, id(known)] = Encoder(vocabulary(path), known)
    return _encoders[path, id(known)]


def decoded(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if ids is None else decode(np.array(ids, np.int64), path) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return common.map_batches(encoded.select("doc_id", "ids"), work, f"doc_id {kind}, text string")
