"""Audit of how far the sources of a language diverge in their words.

The terms of every text are counted per (lang, source). Each language keeps the terms of at least
``LEAST_DOCS`` of its documents and numbers them in blocks of a bounded size. Of every source
and block there is one sorted array of (term number, count). For each unordered pair of sources and
each block the two arrays are co-grouped and merged: a galloping search finds the
terms both have; these, and the terms of one side only, are priced in both directions at
once. Terms that neither has cost the same each, so their number prices them. Sums of the blocks give
a pair's two divergences.

A term's price is ``f = (p - q) * (p - q) div q`` with ``p = 1 + (PARTS * (count + 1)) div (N + V)``, N the
counts of all V kept terms in the group. All of it is whole numbers; N + V may reach 9 * 10**15.

Cases: null text, lang and source count as ''; a group without kept terms has count 0 everywhere;
a language without kept terms has divergences of 0 and no terms; a lone source has no
pairs; repeated rows are documents of their own; an empty table gives an empty result.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.session import written

#: Documents of a language that a kept term is in at least; parts that a share is expressed in.
LEAST_DOCS, PARTS = 3, 1_000_000_000
#: Kept terms of a block, about: the most that one array holds.
BLOCK_TERMS = 1 << 17
#: Distinct (group, term) counts a task holds before it hands them on.
HELD = 2_000_000
#: Terms reported per group.
TOP_TERMS = 200
#: Terms of the shorter array that gallop together.
STRIDE = 1024

# Term bytes: ASCII letters, folded to lower case, and everything that is not ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences, and documents that hold the term, per group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple, Counter] = {}
        holders: dict[tuple, Counter] = {}
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("lang", "source", "text")]
            for lang, source, text in zip(*columns):
                found = terms_of(text)
                if found:
                    occurrences.setdefault((lang, source), Counter()).update(found)
                    holders.setdefault((lang, source), Counter()).update(set(found))
            if sum(map(len, holders.values())) > HELD:
                yield from handed_on(occurrences, holders)
                occurrences, holders = {}, {}
        yield from handed_on(occurrences, holders)

    def handed_on(occurrences: dict, holders: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in occurrences.items():
            words = sorted(counts)  # like bytes side by side compress well
            for at in range(0, len(words), 50_000):
                part = words[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                     pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array(list(map(counts.__getitem__, part)), pa.int64()),
                     pa.array(list(map(holders[lang, source].__getitem__, part)), pa.int64())],
                    ["lang", "source", "term", "n", "d"])

    return (_grouped(docs, F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, "lang string, source string, term string, n bigint, d bigint")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def _grouped(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], *more)


def kept_terms(counts: DataFrame) -> DataFrame:
    """(lang, term, total, block, id): the kept terms of each language, numbered within blocks."""
    kept = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("docs"))
                   .where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "total"), "terms")
    most = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    block = F.pmod(F.xxhash64("term"), F.lit(1 + most // BLOCK_TERMS)).cast("int")
    place = Window.partitionBy("lang", "block").orderBy("term")
    return kept.withColumn("block", block).withColumn("id", F.row_number().over(place))


def share(count: Column, n: Column, v: Column) -> Column:
    """p of a count: one more than its share in whole parts, by long division three digits a step,
    as PARTS times a large count would not fit 64 bits."""
    rest, out = count + 1, F.lit(0).cast("bigint")
    base = F.greatest(n + v, F.lit(1))
    out, rest = F.call_function("div", rest, base), rest % base
    for _ in range(3):
        out, rest = out * 1000 + F.call_function("div", rest * 1000, base), (rest * 1000) % base
    return out + 1


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counts: np.ndarray, base: int) -> np.ndarray:
    """The same as ``share`` for an array of counts; ``base`` is N + V."""
    out, rest = np.divmod(counts.astype(np.int64) + 1, base)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, base)
        out = out * 1000 + digits
    return out + 1


def prices(p: np.ndarray, q: np.ndarray) -> int:
    """The sum of the prices; each fits 64 bits, as does their sum while V stays below 10 ** 9."""
    return int(((p - q) * (p - q) // q).sum())


def intersection(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in two sorted arrays of the numbers both hold.

    The shorter array is walked a stride at a time; from where the last stride ended, steps that
    double find the range of the longer one that can hold the stride, and a binary search in it
    finds the places.
    """
    if len(a) > len(b):
        in_b, in_a = intersection(b, a)
        return in_a, in_b
    at, found_a, found_b = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(a), STRIDE):
        keys, step = a[low:low + STRIDE], STRIDE
        while at + step < len(b) and b[at + step] < keys[-1]:
            step *= 2
        window = b[at:at + step + 1]
        place = np.searchsorted(window, keys)
        hit = np.flatnonzero(window[np.minimum(place, len(window) - 1)] == keys) if len(window) else found_a[0]
        found_a.append(low + hit)
        found_b.append(at + place[hit])
        at += int(place[-1])
    return np.concatenate(found_a), np.concatenate(found_b)


def merged(ids_a: np.ndarray, counts_a: np.ndarray, base_a: int,
           ids_b: np.ndarray, counts_b: np.ndarray, base_b: int) -> tuple[int, int, int]:
    """(terms of either side, price of a against b, price of b against a) over those terms."""
    in_a, in_b = intersection(ids_a, ids_b)
    p, q = shares(counts_a, base_a), shares(counts_b, base_b)
    zero_p, zero_q = (shares(np.zeros(1, np.int64), base) for base in (base_a, base_b))
    only_a, only_b = np.delete(p, in_a), np.delete(q, in_b)
    there = prices(p[in_a], q[in_b]) + prices(only_a, zero_q) + prices(zero_p, only_b)
    back = prices(q[in_b], p[in_a]) + prices(zero_q, only_a) + prices(only_b, zero_p)
    return len(ids_a) + len(ids_b) - len(in_a), there, back


def _vectors(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, block, base, ids, counts): sorted arrays, as packed numbers of the fewest bytes."""
    def pack(rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids)
        counts = rows.column("n").to_numpy()[order]
        # Differences are small numbers, which compress.
        return pa.table({**{name: rows.column(name)[:1] for name in ("lang", "source", "block")},
                         "ids": [_packed(np.diff(ids[order], prepend=0))], "counts": [_packed(counts)]},
                        schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("block", pa.int32()),
                                          ("ids", pa.binary()), ("counts", pa.binary())]))

    packed = kept.select("lang", "source", "block", "id", "n").groupBy("lang", "source", "block").applyInArrow(
        pack, "lang string, source string, block int, ids binary, counts binary")
    return packed.join(groups.select("lang", "source", "base"), ["lang", "source"])


def _packed(numbers: np.ndarray) -> bytes:
    """A first byte for the width, then the numbers."""
    most = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - (w == 8)))
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def divergences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    vectors = written(_vectors(kept, groups), "vectors")
    others = groups.select(F.col("lang").alias("of"), F.col("source").alias("other"))
    # Each array goes to the pairs of its source: as many rows as the result has pairs, for each block.
    sent = (vectors.join(others, (F.col("lang") == F.col("of")) & (F.col("source") != F.col("other")))
            .select("lang", F.least("source", "other").alias("lo"), F.greatest("source", "other").alias("hi"),
                    "block", "source", "base", "ids", "counts"))
    pair = ["lang", "lo", "hi", "block"]

    def side(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
        if not rows.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        row = rows.to_pylist()[0]
        return np.cumsum(_unpacked(row["ids"])), _unpacked(row["counts"]), row["base"]

    names = ["lang", "lo", "hi", "seen", "there", "back"]
    schema = pa.schema([*[(name, pa.string()) for name in names[:3]], *[(name, pa.int64()) for name in names[3:]]])

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        key = (left if left.num_rows else right).slice(0, 1).select(names[:3]).to_pylist()[0]
        (ids_a, counts_a, base_a), (ids_b, counts_b, base_b) = side(left), side(right)
        # An absent side has no term here; its base comes with the other side's rows.
        if not left.num_rows:
            base_a = right.column("other_base")[0].as_py()
        if not right.num_rows:
            base_b = left.column("other_base")[0].as_py()
        seen, there, back = merged(ids_a, counts_a, base_a, ids_b, counts_b, base_b)
        return pa.Table.from_pylist([{**key, "seen": seen, "there": there, "back": back}], schema=schema)

    bases = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.col("base").alias("other_base"))
    other = F.when(F.col("source") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    sent = sent.join(bases, (F.col("lang") == F.col("l")) & (other == F.col("s"))).drop("l", "s")
    # Columns of their own on each side, as Spark takes two parts of one table for ambiguous.
    first, second = (sent.where(F.col("source") == F.col(side)).select([F.col(c).alias(c) for c in sent.columns])
                     for side in ("lo", "hi"))
    by_block = first.groupBy(*pair).cogroup(second.groupBy(*pair)).applyInArrow(
        merge, "lang string, lo string, hi string, seen bigint, there bigint, back bigint")
    sums = by_block.groupBy("lang", "lo", "hi").agg(*[F.sum(c).alias(c) for c in names[3:]])
    ways = written(sums.select("lang", F.explode(F.array(
        F.struct(F.col("lo").alias("source"), F.col("hi").alias("item"), "seen", F.col("there").alias("value")),
        F.struct(F.col("hi").alias("source"), F.col("lo").alias("item"), "seen", F.col("back").alias("value")))).alias("way"))
        .select("lang", "way.*"), "ways")

    a, b = groups.alias("a"), groups.alias("b")
    every = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"),
        F.col("a.v").alias("v"), *[F.when(F.col("a.v") > 0, share(F.lit(0).cast("bigint"), F.col(f"{x}.n"), F.col(f"{x}.v")))
                                   .otherwise(1).alias(name) for x, name in (("a", "p0"), ("b", "q0"))])
    absent = (F.col("v") - F.coalesce("seen", F.lit(0))) * price(F.col("p0"), F.col("q0"))
    return every.join(ways, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.coalesce("value", F.lit(0)) + absent).alias("value"))


def telling_terms(kept: DataFrame, groups: DataFrame, langs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): terms a group has a larger share of than its language."""
    rows = (kept.where(F.col("n") > 0).join(groups.select("lang", "source", F.col("n").alias("n_group"), "v"), ["lang", "source"])
            .join(langs.select("lang", F.col("n").alias("n_lang")), "lang"))
    p, q = share(F.col("n"), F.col("n_group"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
    priced = (rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
              .select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value")))
    return _ranked(priced).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term`` of every group."""
    counts = written(counted(docs), "counts")
    terms = written(kept_terms(counts), "numbered")
    kept = written(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "kept")
    langs = terms.groupBy("lang").agg(F.sum("total").alias("n"), F.count("*").alias("v"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("bigint")
    groups = written(_grouped(docs).distinct().join(sums, ["lang", "source"], "left")
                     .join(langs.select("lang", "v"), "lang", "left")
                     .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"))
                     .withColumn("base", F.col("n") + F.col("v")), "groups")
    parts = {"pair": _ranked(divergences(kept, groups)), "term": telling_terms(kept, groups, langs)}
    found = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts.items()]
    return found[0].unionByName(found[1])
