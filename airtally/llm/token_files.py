"""Token ids as Arrow files of equal-length sequences with masks.

Documents are dealt by ranges of their ids and sorted, so the files hold them in ascending order.
Each task encodes its range with the vocabulary file's own library, ends every document
with an end id and writes the ids one after another into an Arrow IPC file: record batches of
fixed-size lists, ``ids`` (16 or 32 bits, as the vocabulary needs) and ``mask`` (one bit
each, false where the last sequence is filled up). Nothing is compressed, so a memory-mapped file
gives any sequence and its mask as views, without a copy. Beside it lies an index file with a row
per document: ``doc_id``, ``start`` (ids before it in the file), ``n_tokens``.

Files are written through Arrow's file systems into the shared folder under names of their
own for each attempt of a task; the table ``written_files`` returns names those that count,
so a task that runs twice leaves at most a file nobody reads.

Cases: a null or empty text is the end id alone; null ids come last; rows of one id are ordered by a
hash of their text, each row is a document; a very long text runs over as many
sequences as it needs; an empty table gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm import bpe, chunks, common
from airtally.session import written

#: Ids of a sequence, and sequences of a record batch.
LENGTH, SEQUENCES = 1024, 256
#: Characters handed to the library at once where many chunks are new.
JOINED = 1 << 14


class LibraryEncoder:
    """Whole texts to ids by the tokenizers library, each different chunk once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        steps = read["pre_tokenizer"] or {}
        # Chunks are known to be cut where this kind of pre-tokeniser cuts.
        self.by_chunk = (read["normalizer"] is None and steps.get("type") == "ByteLevel"
                         and not steps.get("add_prefix_space") and steps.get("use_regex", True))
        pieces = bpe.vocabulary(path).pieces if self.by_chunk else []
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks = chunks.ByChunk(self.kind, self._learn, self.whole, [token["content"] for token in read["added_tokens"]])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return self.chunks.encode(texts) if self.by_chunk else list(map(self.whole, texts))

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        part, size = [], 0
        for chunk in new:
            joined = chunk[:1] != " " and chunks.joins(chunk)
            if part and (not joined or size > JOINED):
                self._learn_joined(part, ids, sizes)
                part, size = [], 0
            if joined:
                part.append(chunk)
                size += len(chunk) + 1
            else:
                ids.append(self.whole(chunks.text_of(chunk)))
                sizes.append(np.array([len(ids[-1])]))
        if part:
            self._learn_joined(part, ids, sizes)
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn_joined(self, part: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Encode chunks as one text: the bytes of its ids show where each chunk ends."""
        ids.append(self.whole(" " + " ".join(part)))
        ends = np.cumsum(self.lengths[ids[-1]])
        wanted = np.cumsum([len(chunk.encode()) + 1 for chunk in part])
        at = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[at], wanted):
            raise ValueError("an id crosses the border of two chunks")
        sizes.append(np.diff(at, prepend=-1))


@cache
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


class _Writer:
    """One data file and its index, written as the ids come, a record batch at a time."""

    def __init__(self, folder: str, kind: np.dtype, id_kind: pa.DataType, length: int, sequences: int) -> None:
        self.files, path = pa.fs.FileSystem.from_uri(folder)
        name = uuid.uuid4().hex
        self.data, self.index = f"{folder}/{name}.ids.arrow", f"{folder}/{name}.documents.arrow"
        self.kind, self.length, self.room = kind, length, length * sequences
        values = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(values, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", id_kind), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.streams = [self.files.open_output_stream(f"{path}/{name}.{what}.arrow") for what in ("ids", "documents")]
        self.ids = pa.ipc.new_file(self.streams[0], self.schema)
        self.documents = pa.ipc.new_file(self.streams[1], self.index_schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.rows = 0

    def add(self, doc_ids: pa.Array, texts: list[np.ndarray]) -> None:
        sizes = np.array([len(ids) for ids in texts], np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.documents.write_batch(pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(starts), pa.array(sizes)], schema=self.index_schema))
        self.tokens += int(sizes.sum())
        self.rows += len(texts)
        self.waiting.extend(texts)
        self.held += int(sizes.sum())
        if self.held >= self.room:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.room * self.room
            for at in range(0, whole, self.room):
                self._write(ids[at:at + self.room], self.room)
            self.waiting, self.held = [ids[whole:].copy()], len(ids) - whole

    def _write(self, ids: np.ndarray, room: int) -> None:
        mask = np.zeros(room, bool)
        mask[:len(ids)] = True
        filled = np.zeros(room, self.kind)
        filled[:len(ids)] = ids
        self.ids.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(filled), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.waiting), -(-self.held // self.length) * self.length)
        for writer in (self.ids, self.documents, *self.streams):
            writer.close()


class Sequences:
    """Random access to a data file: sequences by number, ids by place.

    A file of a local folder is mapped into memory and nothing is copied; others are
    read a record batch at a time.
    """

    def __init__(self, uri: str) -> None:
        self.source = _opened(uri)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.per_batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self.number, self.batch = -1, None

    def __len__(self) -> int:
        last = self.file.num_record_batches - 1
        return last * self.per_batch + self.file.get_batch(last).num_rows if last >= 0 else 0

    def _batch(self, number: int) -> pa.RecordBatch:
        if number != self.number:
            self.number, self.batch = number, self.file.get_batch(number)
        return self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids and the mask of a sequence, as views."""
        batch, row = self._batch(i // self.per_batch), i % self.per_batch
        ids = batch.column("ids").values.to_numpy(zero_copy_only=True)
        return ids[row * self.length:(row + 1) * self.length], batch.column("mask")[row].values

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """``n`` ids from a place on, as a view for each record batch they lie in."""
        room = self.per_batch * self.length
        while n > 0:
            at = start % room
            ids = self._batch(start // room).column("ids").values.to_numpy(zero_copy_only=True)[at:at + n]
            yield ids
            start, n = start + len(ids), n - len(ids)

    def close(self) -> None:
        self.batch = self.file = None
        self.source.close()


def _opened(uri: str) -> pa.NativeFile:
    files, path = pa.fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)


def documents_in(index: str) -> Iterator[pa.RecordBatch]:
    """The record batches of an index file."""
    with _opened(index) as source:
        file = pa.ipc.open_file(source)
        for i in range(file.num_record_batches):
            yield file.get_batch(i)


def written_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, length: int = LENGTH,
                  sequences: int = SEQUENCES) -> DataFrame:
    """Write all documents below ``folder``; (part, data, index, documents, tokens, start) per file.

    ``part`` numbers the files in the order of the documents, ``start`` counts the ids of all
    files before. The table is stored, as the files are written while it is computed.
    """
    files, place = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = _encoder(path), None
        end = np.array([end_id], encoder.kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = out or _Writer(folder, encoder.kind, batch.schema.field("doc_id").type, length, sequences)
                out.add(part.column("doc_id"), [np.concatenate([ids, end]) for ids in encoder.encode(common.texts_of(part))])
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "data": out.data,
                                               "index": out.index, "documents": out.rows, "tokens": out.tokens}])

    # The hash spreads the rows of one id, or of none, over files.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(rows.mapInArrow(run, "part bigint, data string, index string, documents bigint, tokens bigint"), "files")
    # A row per file, so the window is short.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))


def read_back(files: DataFrame, columns: str, row: Callable[[Iterator[np.ndarray]], tuple], id_kind: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens) and what ``row`` makes of the ids, of every document in the files.

    ``row`` gets the ids as pieces in order; each file is one row of its own task as far as possible.
    """
    names = [pair.split(" ")[0] for pair in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                ids = Sequences(file["data"])
                for part in documents_in(file["index"]):
                    places = zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist())
                    made = [row(ids.span(start, n)) for start, n in places]
                    starts = pa.array(part.column("start").to_numpy() + file["start"])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), starts, part.column("n_tokens"),
                         *[pa.array(values) for values in zip(*made)]], ["doc_id", "start", "n_tokens", *names])
                ids.close()

    spread = files.repartitionByRange(max(1, files.count()), "part")
    return spread.mapInArrow(run, f"doc_id {id_kind}, start bigint, n_tokens bigint, {columns}")


def _crc(pieces: Iterator[np.ndarray]) -> tuple[int]:
    total = 0
    for ids in pieces:
        total = zlib.crc32(ids.astype("<u4").tobytes(), total)
    return (total,)


def checksums(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from files written below ``folder``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_back(written_files(docs, folder, path), "ids_crc32 bigint", _crc, kind)
