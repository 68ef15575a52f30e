"""Secret scan: keyword prefilter, anchored expressions near hits, checksum validation.

An Aho-Corasick automaton finds all keywords of a text in one pass; the regular expressions
are tried only where a keyword starts. Hexadecimal runs have no keyword: the text is mapped to
"hex digit or not" and a run of 24 is the keyword. Tokens that embed a checksum
(base-62 CRC-32, base-58 double SHA-256) count only if it holds.

Kinds, in their order: ``assign``, ``access``, ``hex``, then the checksummed ``token`` and
``wallet``. Within a kind matches are leftmost and do not overlap; a match that fails its
test is dropped but still takes its place.

Cases: null text is empty; each input row gives one row, repeated rows included; no finding
gives an empty list. Other columns are not read by ``find``; ``redact`` keeps them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.llm import common

KINDS = ("assign", "access", "hex", "token", "wallet")
BASE = KINDS[:3]

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_HEX_RUN = 24
_HEX_MAP = bytes(104 if chr(i) in "0123456789abcdef" else 32 for i in range(256))


def crc_base62(body: str) -> str:
    """CRC-32 of the characters as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def base58_valid(text: str) -> bool:
    """Whether the last four bytes are the start of the double SHA-256 of the rest."""
    value = 0
    for letter in text:
        value = value * 58 + _BASE58.index(letter)
    raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return len(raw) > 4 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


#: Kind: keywords (lower case), anchored expression, test of a match.
RULES: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"),
               re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A),
               lambda m: len(m[2]) >= 6),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "token": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
              re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
              lambda m: crc_base62(m[1]) == m[2]),
    "wallet": (("xprv",), re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
               lambda m: base58_valid(m[0])),
}


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


def _hex_runs(text: str) -> list[tuple[int, int]]:
    data = text.encode("utf-8")
    mapped = data.translate(_HEX_MAP)
    out, at, before, letters = [], 0, 0, 0
    while (start := mapped.find(b"h" * _HEX_RUN, at)) >= 0:
        if (end := mapped.find(b" ", start)) < 0:
            end = len(mapped)
        letters += len(data[before:start].decode("utf-8"))
        out.append((letters, letters + end - start))
        letters, before, at = letters + end - start, end, end
    return out


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every finding in code points, in order."""
    found = [(start, KINDS.index("hex"), end) for start, end in _hex_runs(text)]
    free = dict.fromkeys(RULES, 0)
    for last, (kind, length) in _automaton().iter(_lowered(text)):
        start = last - length + 1
        if start >= free[kind] and (match := RULES[kind][1].match(text, start)):
            free[kind] = match.end()
            if RULES[kind][2](match):
                found.append((start, KINDS.index(kind), match.end()))
    return sorted(found)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end) for every row."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(text)] for text in common.texts_of(batch)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(docs.select("doc_id", "text"), work,
                              f"doc_id {kind}, spans array<struct<kind string, start bigint, end bigint>>")


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every finding, joined where they overlap, replaced by a mark."""
    out, done = [], 0
    for start, _, end in spans(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced in ``text``; null stays null, other columns stay."""
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else redacted(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(i) for i, name in enumerate(names)]
        return pa.RecordBatch.from_arrays(columns, names)

    return common.map_batches(docs, work, docs.schema)


def joined_spans(spans_column: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(kind) for kind in BASE],
                        F.sha2(joined_spans(base), 256).alias("base_sha256"),
                        joined_spans(F.col("spans")).alias("spans"))
