"""Ranked lexical search by Block-Max MaxScore over sharded inverted indexes.

Each task turns the documents it reads into shards of a bounded size: posting lists of every term,
in blocks of ``BLOCK`` postings packed as variable-length numbers, with the last document and
the largest impact of each block and the largest of the list. The index is a table with a row per
shard and term, so a search reads the lists of its terms only; the lists of a shard meet
in one task, a slice of the items at a time.

A shard is searched in windows of ascending documents. Lists are ordered by their largest share
of a score. Those whose shares add up to no more than the item's worst kept score cannot bring a new
document and are non-essential: only the others are read for candidates. For a candidate the
non-essential lists are asked from the strongest on, and it goes, before a block is unpacked,
as soon as the block's maximum and what is left cannot lift it over that score. The
best of each shard are merged per item.

Weights, lengths and scores are whole numbers as ``impact`` and ``weight`` define them.

Cases: null or empty texts, or texts without a term, are no documents and no queries; rows of one item_id
are one item with the terms of all; repeated rows are documents of their own; a null doc_id
comes after all others of its score; a document with more postings than a shard holds is
a shard of its own; empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm import common
from airtally.session import written

#: Results per item.
TOP = 50
#: Postings of a block.
BLOCK = 64
#: Documents and postings of a shard, about.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 21
#: Items that one task looks for in a shard.
SLICE_ITEMS = 512
#: Documents of the first window; each next one is twice as large.
WINDOW = 512

# Term bytes: ASCII letters, folded to lower case, digits, and everything that is not ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def weight(n_docs: int, df: Column) -> Column:
    """A term's weight from the documents that hold it."""
    return F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * df + 1).cast("double"))).cast("bigint")


def spread(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m from its number of terms."""
    return 100 - 50 + 50 * n.astype(np.int64) * n_docs // n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score, for each unit of its weight."""
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def totals(docs: DataFrame) -> tuple[int, int]:
    """The documents with a term, and all their terms."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [len(terms_of(text)) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array([sum(map(bool, sizes))]), pa.array([sum(sizes)])], ["docs", "terms"])

    row = common.map_batches(docs.select("text"), work, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes, seven bits each and the low ones first; and where each number starts."""
    width = np.ones(len(values), np.int64)
    for k in range(1, 5):
        width += values >= 1 << 7 * k
    starts = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint8)
    for k in range(5):
        has = np.flatnonzero(width > k)
        if not len(has):
            break
        more = (width[has] > k + 1).astype(np.uint8) << 7
        out[starts[has] + k] = (values[has] >> 7 * k & 127).astype(np.uint8) | more
    return out, starts


def unpacked(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    values = np.zeros(len(ends), np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    for k in range(int((ends - starts).max(initial=-1)) + 1):
        has = np.flatnonzero(ends - starts >= k)
        values[has] |= (data[starts[has] + k] & 127).astype(np.int64) << 7 * k
    return values


class _Numbers(dict):
    """Numbers strings as they first come."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


class Builder:
    """Gathers documents and gives the rows of a shard."""

    NAMES = ("shard", "term", "df", "best", "blocks", "data")
    SCHEMA = "shard bigint, term string, df bigint, best bigint, blocks binary, data binary"

    def __init__(self, n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.numbers, self.ids = _Numbers(), []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.postings = 0

    def add(self, doc_id: int | None, found: list[bytes]) -> None:
        counts = Counter(found)
        self.terms.append(np.fromiter(map(self.numbers.__getitem__, counts), np.int32, len(counts)))
        self.counts.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.postings += len(counts)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The documents' row, with a null term and ``df`` non-null ids, then a row per term."""
        place = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        number = np.empty(len(place), np.int32)
        number[place] = np.arange(len(place), dtype=np.int32)
        ids = np.array([self.ids[i] or 0 for i in place], np.int64)
        lengths = np.array(self.lengths, np.int64)[place]
        yield self._batch(shard, pa.array([None], pa.string()), [sum(i is not None for i in self.ids)], [0],
                          pa.array([ids.tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary()))

        doc = np.repeat(number, [len(t) for t in self.terms])
        term, tf = np.concatenate(self.terms), np.concatenate(self.counts)
        order = np.lexsort((doc, term))
        doc, term, tf = doc[order], term[order], tf[order]
        del order
        heads = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(heads, append=len(term))
        inside = np.arange(len(term)) - np.repeat(heads, df)
        first = np.flatnonzero(inside % BLOCK == 0)
        most = np.maximum.reduceat(impact(tf, spread(lengths, self.n_docs, self.n_terms)[doc]), first)
        steps = np.diff(doc, prepend=0)
        steps[first] = doc[first]
        data, starts = packed(np.stack([steps, tf], 1).ravel())
        starts = np.append(starts[::2], len(data))
        block_ends = np.append(first[1:], len(term))
        blocks = -(-df // BLOCK)
        head_blocks = np.cumsum(blocks) - blocks
        best = np.maximum.reduceat(most, head_blocks)
        # Lists of one block need no table of their blocks.
        several = np.repeat(blocks > 1, blocks)
        table = np.zeros(int(several.sum()), BLOCK_ROW)
        table["last"], table["most"] = doc[block_ends - 1][several], most[several]
        table["end"] = (starts[block_ends] - np.repeat(starts[heads], blocks))[several]
        rows = np.where(blocks > 1, blocks, 0)
        words = list(self.numbers)
        spans = [np.append(0, np.cumsum(rows)) * BLOCK_ROW.itemsize, np.append(starts[heads], len(data))]
        columns = [_binary(offsets, values) for offsets, values in zip(spans, (table.tobytes(), data.tobytes()))]
        for at in range(0, len(words), 20_000):
            part = slice(at, at + 20_000)
            yield self._batch(shard, pa.array(words[part], pa.binary()).cast(pa.string()), df[part], best[part],
                              *[column.slice(at, 20_000) for column in columns])

    def _batch(self, shard: int, term: pa.Array, df: object, best: object, blocks: pa.Array, data: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(term), pa.int64()), term, pa.array(df, pa.int64()), pa.array(best, pa.int64()), blocks, data],
            list(self.NAMES))


#: A block's last document, where it ends in the list's bytes, and its largest impact.
BLOCK_ROW = np.dtype([("last", "<i4"), ("end", "<i4"), ("most", "<i8")])


def _binary(offsets: np.ndarray, values: bytes) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


def index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index of all documents, stored: a row per shard and term, and one per shard for its documents.

    Shards come from the tasks that read the documents, so nothing is shuffled; small
    partitions are read together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, shard = Builder(n_docs, n_terms), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if found := terms_of(text):
                    builder.add(doc_id, found)
                    if len(builder.ids) >= 2 * SHARD_DOCS or builder.postings >= SHARD_POSTINGS:
                        yield from builder.rows(shard)
                        builder, shard = Builder(n_docs, n_terms), shard + 1
        if builder.ids:
            yield from builder.rows(shard)

    tasks = max(1, n_docs // SHARD_DOCS, n_terms // (2 * SHARD_POSTINGS))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").coalesce(tasks)
    return written(rows.mapInArrow(run, Builder.SCHEMA), "index")


class PostingList:
    """A list of one shard; blocks are unpacked when first asked for, and kept."""

    def __init__(self, weight: int, df: int, best: int, blocks: bytes, data: bytes, m: np.ndarray) -> None:
        self.bound, self.weight, self.df, self.m = weight * best, weight, df, m
        self.data = np.frombuffer(data, np.uint8)
        table = np.frombuffer(blocks, BLOCK_ROW)
        if len(table):
            self.last, self.ends, self.most = table["last"], table["end"], table["most"] * weight
        else:
            self.last, self.ends = np.array([len(m)], np.int32), np.array([len(data)], np.int32)
            self.most = np.array([self.bound])
        self.have = np.zeros(len(self.last), bool)
        self.doc, self.share = np.zeros(df, np.int32), np.zeros(df, np.int64)

    def need(self, blocks: np.ndarray) -> None:
        """Unpack those of the sorted blocks that are not yet."""
        todo = blocks[~self.have[blocks]]
        if not len(todo):
            return
        for run in np.split(todo, np.flatnonzero(np.diff(todo) > 1) + 1):
            low, high = int(run[0]), int(run[-1]) + 1
            values = unpacked(self.data[self.ends[low - 1] if low else 0:self.ends[high - 1]])
            at = low * BLOCK
            steps, tf = np.cumsum(values[::2]), values[1::2]
            before = np.append(0, steps)[np.arange(0, len(steps), BLOCK)]
            doc = steps - np.repeat(before, BLOCK)[:len(steps)]
            self.doc[at:at + len(doc)], self.share[at:at + len(doc)] = doc, impact(tf, self.m[doc]) * self.weight
        self.have[todo] = True

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents from low to below high, with their shares."""
        first, last = np.searchsorted(self.last, (low, high - 1))
        blocks = np.arange(first, min(last + 1, len(self.last)))
        self.need(blocks)
        start, stop = first * BLOCK, min((last + 1) * BLOCK, self.df)
        a, b = np.searchsorted(self.doc[start:stop], (low, high)) + start
        return self.doc[a:b], self.share[a:b]

    def at(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The shares of sorted documents that lie in the blocks, 0 where the list has none."""
        self.need(np.unique(blocks))
        # Blocks that were not unpacked hold zeros, so each document is looked for in its own block.
        low = blocks.astype(np.int64) * BLOCK
        high = np.minimum(low + BLOCK, self.df)
        for _ in range(BLOCK.bit_length()):
            middle = (low + high) // 2
            right = (low < high) & (self.doc[np.minimum(middle, self.df - 1)] < docs)
            low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
        place = np.minimum(low, self.df - 1)
        return np.where(self.doc[place] == docs, self.share[place], 0)


def best_documents(lists: list[PostingList], n: int, top: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a shard's ``top`` for one item: score above 0, best first, ties by number."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    sums = np.cumsum([0, *[x.bound for x in lists]])
    kept, scores, worst, low = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
    while low < n:
        # The first lists together cannot lift a document over the worst score kept.
        idle = int(np.searchsorted(sums, worst, "right")) - 1
        if idle == len(lists):
            break
        high = min(low + window, n)
        total = np.zeros(high - low, np.int64)
        for found in lists[idle:]:
            docs, shares = found.between(low, high)
            total[docs - low] += shares
        docs = np.flatnonzero((total > 0) & (total + sums[idle] > worst))
        total, docs = total[docs], docs + low
        for k in range(idle - 1, -1, -1):
            if not len(docs):
                break
            found = lists[k]
            block = np.searchsorted(found.last, docs)
            within = block < len(found.last)
            block = np.minimum(block, len(found.last) - 1)
            possible = total + np.where(within, found.most[block], 0) + sums[k] > worst
            docs, total, block, within = docs[possible], total[possible], block[possible], within[possible]
            if within.any():
                total[within] += found.at(docs[within], block[within])
            possible = total + sums[k] > worst
            docs, total = docs[possible], total[possible]
        kept, scores = np.concatenate([kept, docs]), np.concatenate([scores, total])
        order = np.lexsort((kept, -scores))[:top]
        kept, scores = kept[order], scores[order]
        worst = int(scores[-1]) if len(scores) == top else 0
        low, window = high, window * 2
    return kept, scores


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(set(terms_of(text))) for text in batch.column("text").to_pylist()]
        at = np.repeat(np.arange(len(found)), [len(f) for f in found])
        words = pa.array([term for f in found for term in f], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at)), words], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return common.map_batches(items.select("item_id", "text"), work, f"item_id {kind}, term string").distinct()


def search(lists: DataFrame, items: DataFrame, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's best documents in a stored index."""
    wanted = written(item_terms(items), "item-terms")
    kind = items.schema["item_id"].dataType.simpleString()
    slices = 1 + wanted.select("item_id").distinct().count() // SLICE_ITEMS
    by_term = wanted.withColumn("slice", F.pmod(F.xxhash64("item_id"), F.lit(slices)).cast("int")).groupBy("term", "slice").agg(
        F.collect_list(F.struct("item_id")).alias("items"))  # at most the items of a slice
    found = written(lists.join(wanted.select("term").distinct(), "term"), "found")
    weights = found.groupBy("term").agg(weight(n_docs, F.sum("df")).alias("weight"))
    rows = found.join(weights, "term").join(by_term, "term").select("slice", "items", "weight", *Builder.NAMES)
    docs = lists.where(F.col("term").isNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(None).cast(rows.schema["items"].dataType).alias("items"),
        F.lit(0).cast("bigint").alias("weight"), *Builder.NAMES)
    schema = pa.schema([("item_id", pa.null()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        own = schema.set(0, pa.field("item_id", group.schema.field("items").type.value_type.field("item_id").type))
        by_item: dict[object, list[PostingList]] = {}
        head = group.filter(pa.compute.is_null(group.column("term"))).to_pylist()[0]
        ids, lengths = (np.frombuffer(head[name], np.int64) for name in ("blocks", "data"))
        m = spread(lengths, n_docs, n_terms)
        for row in group.filter(pa.compute.is_valid(group.column("term"))).to_pylist():
            one = PostingList(row["weight"], row["df"], row["best"], row["blocks"], row["data"], m)
            for item in row["items"]:
                by_item.setdefault(item["item_id"], []).append(one)
        out = []
        for item, its_lists in by_item.items():
            docs, scores = best_documents(its_lists, len(ids), top)
            out += [(item, int(ids[d]) if d < head["df"] else None, s) for d, s in zip(docs.tolist(), scores.tolist())]
        return pa.Table.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*out) if out else [[]] * 3, own)], schema=own)

    best = rows.unionByName(docs).groupBy("shard", "slice").applyInArrow(run, f"item_id {kind}, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents of each item, from an index made of ``docs``."""
    n_docs, n_terms = totals(docs)
    return search(index(docs, max(n_docs, 1), max(n_terms, 1)), items, max(n_docs, 1), max(n_terms, 1), top)
