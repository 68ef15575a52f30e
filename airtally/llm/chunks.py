"""Texts cut before single spaces, where byte-level pre-tokenisers cut too.

A pre-token is an optional space and a run of letters, numbers or other signs, or a run of
white space that leaves its last space to the sign after it. So a pre-token always begins at a
space that has a sign before or after it. Cut there, a text falls into far fewer different chunks
than it has words, and each needs encoding once only.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: Chunks, and characters of chunks, that a worker remembers.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 1 << 26

#: A space between other white space and white space: no pre-token need begin there. Python
#: knows all white space of the pre-tokeniser, and some more.
_UNSURE = re.compile(r"[^\S ] \s")


def cut(text: str) -> list[str] | None:
    """The chunks without the space before each (the first has none); None where the text
    cannot be cut so."""
    pieces = text.split(" ")
    if pieces.count("") > (pieces[0] == "") or _UNSURE.search(text):
        return None
    return pieces


def joins(piece: str) -> bool:
    """Whether the chunk may follow any other: a sign comes after its space."""
    return bool(piece) and not piece[0].isspace()


class _Numbers(dict):
    """Numbers strings as they first come; ``new`` lists them."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind: np.dtype | type) -> None:
        self.values, self.n = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.values):
            self.values = np.concatenate([self.values[:self.n], np.zeros(self.n + len(more), self.values.dtype)])
        self.values[self.n:self.n + len(more)] = more
        self.n += len(more)


def text_of(chunk: str) -> str:
    """The text a remembered chunk stands for: with a space before it, but for the first of a text,
    which is kept with a space in front to tell it apart."""
    return chunk[1:] if chunk[:1] == " " else " " + chunk


class ByChunk:
    """Ids of whole texts from the ids of their chunks, each different chunk encoded once.

    ``learn`` gives the ids of new chunks (see ``text_of``), one after another, and how many each
    has; ``whole`` the ids of a text that cannot be cut, as one that holds an ``added`` token: white
    space before such a token ends a text of its own. The memory has a bound and starts anew beyond it.
    """

    def __init__(self, kind: np.dtype | type, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 whole: Callable[[str], np.ndarray], added: list[str]) -> None:
        self.kind, self.learn, self.whole, self.added = kind, learn, whole, added
        self.forget()

    def forget(self) -> None:
        """Nothing remembered: a chunk's number gives the place and length of its ids in ``ids``."""
        self.numbers, self.chars = _Numbers(), 0
        self.ids, self.starts, self.sizes = _Grown(self.kind), _Grown(np.int64), _Grown(np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        found: list[np.ndarray] = []
        for text in texts:
            pieces = None if any(token in text for token in self.added) else cut(text)
            if pieces is None:
                pieces = []
            else:
                # No other chunk holds a space.
                pieces[0] = " " + pieces[0]
            found.append(np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces)))
        new, self.numbers.new = self.numbers.new, []
        if new:
            self.chars += sum(map(len, new))
            ids, sizes = self.learn(new)
            self.starts.add(self.ids.n + np.cumsum(sizes) - sizes)
            self.sizes.add(sizes)
            self.ids.add(ids)
        numbers = np.concatenate(found or [np.zeros(0, np.int64)])
        sizes = self.sizes.values[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids.values[np.repeat(self.starts.values[numbers] - ends + sizes, sizes) + np.arange(total)]
        ends = np.concatenate([[0], ends])[np.cumsum([0, *map(len, found)])]
        return [ids[low:high] if len(part) else self.whole(text)
                for text, part, low, high in zip(texts, found, ends, ends[1:])]
