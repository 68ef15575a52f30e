"""Mixing sources to target weights by entropy balancing.

Document rates ``r`` minimise the entropy distance ``sum r ln r`` from taking each document once,
under one word constraint per source, ``sum r * size = target``, and ``0 <= r <= 3``. The
solution is exponentially tilted: ``r = min(3, exp(lambda_source * size))``. The duals are found by
distributed Newton steps: all documents of a source with one size share a rate, so each step is an aggregation
of the (source, size) counts. A step that leaves the bracket around the root is
replaced by its middle.

Rates become copies by systematic rounding: along a fixed order of a source's documents the
fractions are added up and a copy is taken whenever the sum passes a whole number. The
words still missing or too many are then evened out with small documents. Running sums go
through totals of (source, size band, hash slot), never through one task per source.

Everything is DataFrame expressions. The same input gives the same mix.

Cases: a null or blank text has size 0 and takes 0 words; null sources are a source of their own,
last in order; repeated rows are documents of their own (equal rows may share copies unevenly);
null ids are ordered first; an empty table gives an empty mix; if all sizes are 0 all targets are 0.
``plan`` reads ``doc_id, text, source`` only; ``mixed_documents`` keeps the documents' columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm import rules
from airtally.session import written

#: No document, and so no source, is taken more often than this.
MOST = 3
#: Newton steps at most, and the relative error of a source's words at which they end.
STEPS, EXACT = 40, 1e-6
#: A source's size bands are cut by hash into at least 2 ** SLOT_BITS slots for running sums, and into
#: more where the table has over SLOT_ROWS rows for each: no task sorts more than a bounded share.
SLOT_BITS, SLOT_ROWS = 6, 1 << 17
#: Rates are added up as whole parts of a copy, so sums do not depend on order. Of parts
#: this size a long holds those of 10 ** 11 documents.
PART_BITS = 24


def sources(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, documents, target): one row per source.

    Weights repeat over the sources in code point order, null last. A target stops at MOST times
    its source's size; the excess goes to the others by weight. The capped sources are those
    with the smallest size per weight, so running totals in that order give the common level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.lit(1)).alias("documents"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(len(weights)))).cast("double")
    cap = (MOST * F.col("source_size")).cast("double")
    every = Window.partitionBy()
    before = (Window.orderBy("per_weight", F.col("source").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    shared = (per.withColumn("weight", weight).withColumn("cap", cap)
              .withColumn("per_weight", F.col("cap") / F.col("weight")).withColumn("level", level)
              .withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level")))
    # The level of the first source that is not capped holds for all that are not.
    common = F.min(F.when(~F.col("capped"), F.struct("per_weight", "level"))).over(every)["level"]
    return shared.select("source", "source_size", "documents",
                         F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * common).alias("target"))


def _rate() -> Column:
    """A document's rate from its size and its source's dual."""
    return F.when(F.col("full"), F.lit(float(MOST))).otherwise(
        F.least(F.lit(float(MOST)), F.exp(F.least(F.col("dual") * F.col("size") / F.col("scale"), F.lit(50.0)))))


def duals(cells: DataFrame, per_source: DataFrame) -> DataFrame:
    """(source, target, full, scale, dual) after Newton steps on the (source, size, n) counts.

    ``dual`` is per ``scale`` words, the source's mean size. ``full``: the target takes
    all documents as often as allowed.
    """
    most_dual = float(50)
    state = written(per_source.where("source_size > 0").select(
        "source", "target", (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)).alias("full"),
        (F.col("source_size") / F.col("documents")).alias("scale"), F.lit(0.0).alias("dual"),
        F.when(F.col("target") < F.col("source_size"), -most_dual * F.col("source_size")).otherwise(0.0).alias("low"),
        F.when(F.col("target") < F.col("source_size"), 0.0).otherwise(most_dual * F.col("source_size")).alias("high"),
        F.lit(1.0).alias("error")), "duals")
    for _ in range(STEPS):
        words = F.col("n") * F.col("size") * F.col("rate")
        sums = (cells.join(state, cells["source"].eqNullSafe(state["source"])).drop(cells["source"])
                .where(~F.col("full")).withColumn("rate", _rate())
                .groupBy("source").agg(F.sum(words).alias("taken"), F.sum(F.when(
                    F.col("rate") < MOST, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope")))
        off = F.col("taken") - F.col("target")
        # Newton on the logarithm of the words: nearly straight in the dual.
        step = F.col("dual") - F.col("taken") / F.col("slope") * F.log(F.col("taken") / F.col("target"))
        low = F.when(off < 0, F.greatest("low", "dual")).otherwise(F.col("low"))
        high = F.when(off > 0, F.least("high", "dual")).otherwise(F.col("high"))
        stepped = (state.drop("error").join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
                   .withColumn("low", low).withColumn("high", high)
                   .withColumn("error", F.coalesce(F.abs(off) / F.col("target"), F.lit(0.0)))
                   .withColumn("step", F.when((F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high")), step)
                               .otherwise((F.col("low") + F.col("high")) / 2))
                   .withColumn("dual", F.when(F.col("error") <= EXACT, F.col("dual")).otherwise(F.col("step"))))
        state = written(stepped.select(state.columns), "duals")
        if state.where(F.col("error") > EXACT).isEmpty():
            break
    return state.select(F.col("source").alias("source_of"), "target", "full", "scale", "dual")


def _running(rows: DataFrame, value: str, order: list[Column]) -> DataFrame:
    """``before``: the sum of ``value`` over earlier rows of a source, in the order of ``band``
    (large first), ``slot`` and then ``order``.

    Totals of the groups come first; only within a group are rows sorted.
    """
    group = ["source", "band", "slot"]
    totals = rows.groupBy(*group).agg(F.sum(value).alias("total"))
    earlier = (Window.partitionBy("source").orderBy(F.desc("band"), "slot")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.withColumn("offset", F.coalesce(F.sum("total").over(earlier), F.lit(0).cast("long")))
    offsets = offsets.select(*[F.col(c).alias(f"{c}_of") for c in group], "offset")
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(offsets, F.col("source").eqNullSafe(F.col("source_of")) & (F.col("band") == F.col("band_of"))
                       & (F.col("slot") == F.col("slot_of"))).drop("source_of", "band_of", "slot_of")
    return joined.withColumn("before", F.col("offset") + F.coalesce(F.sum(value).over(inside), F.lit(0).cast("long"))
                             ).drop("offset")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(rules.words_of(F.col("text"))).cast("long").alias("size"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate, source) of every document."""
    sizes = written(_sized(docs), "sizes")
    per_source = written(sources(sizes, weights), "sources")
    cells = written(sizes.where("size > 0").groupBy("source", "size").agg(F.sum(F.lit(1)).alias("n")), "cells")
    found = duals(cells, per_source)

    rated = (sizes.join(found, F.col("source").eqNullSafe(F.col("source_of")), "left").drop("source_of")
             .withColumn("rate", F.when(F.col("size") > 0, _rate()).otherwise(F.lit(0.0))))
    parts = F.round(F.col("rate") * F.lit(float(1 << PART_BITS))).cast("long")
    # Slots are the first bits of the hash that orders the rows: their number does not change the order.
    bits = max(SLOT_BITS, (sizes.count() // SLOT_ROWS).bit_length())
    rows = (rated.withColumn("parts", F.coalesce(parts, F.lit(0).cast("long")))
            .withColumn("band", F.floor(F.log2(F.col("size") + F.lit(1.0))).cast("int"))
            .withColumn("spread", F.xxhash64("doc_id"))
            .withColumn("slot", F.shiftrightunsigned("spread", 64 - bits).cast("int")))
    half = F.lit(1 << (PART_BITS - 1))
    rounded = _running(rows, "parts", [F.col("spread"), F.col("doc_id"), F.col("size")])
    copies = (F.shiftright(F.col("before") + F.col("parts") + half, PART_BITS)
              - F.shiftright(F.col("before") + half, PART_BITS))
    rounded = written(rounded.withColumn("copies", F.least(F.greatest(copies, F.lit(0).cast("long")), F.lit(MOST).cast("long")))
                      .select("doc_id", "source", "size", "rate", "band", "spread", "slot", "copies"), "rounded")
    evened = _evened(rounded, per_source)
    return (evened.join(per_source.withColumnRenamed("source", "source_of"),
                        F.col("source").eqNullSafe(F.col("source_of")), "left")
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "copies", "rate", "source"))


def _evened(rounded: DataFrame, per_source: DataFrame) -> DataFrame:
    """Copies changed by one where that brings a source's words nearer its target.

    With too many words, documents with a copy lose one; with too few, documents below the limit
    gain one: in a fixed order from large to small those that wholly fit the rest. Two passes, the
    second for what larger documents left.
    """
    def passed(rows: DataFrame) -> DataFrame:
        totals = (rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
                  .join(per_source.select(F.col("source").alias("source_of"), "target"),
                        F.col("source").eqNullSafe(F.col("source_of"))).drop("source_of")
                  .select(F.col("source").alias("source_of"), F.round(F.col("target") - F.col("taken")).cast("long").alias("miss")))
        open_ = (rows.join(totals, F.col("source").eqNullSafe(F.col("source_of"))).drop("source_of")
                 .withColumn("movable", (F.col("size") > 0) & (F.col("size") <= F.abs("miss")) & F.when(
                     F.col("miss") < 0, F.col("copies") > 0).otherwise(F.col("copies") < MOST))
                 .withColumn("value", F.when(F.col("movable"), F.col("size")).otherwise(F.lit(0).cast("long"))))
        running = _running(open_, "value", [F.col("spread"), F.col("doc_id"), F.col("size")])
        fits = F.col("movable") & (F.col("before") + F.col("size") <= F.abs("miss"))
        return running.withColumn("copies", F.col("copies") + F.when(fits, F.signum("miss").cast("long")).otherwise(
            F.lit(0).cast("long"))).select(rows.columns)

    return passed(written(passed(rounded), "evened"))


def mixed(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    return plan(docs).select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), "taken")


def _key(doc_id: Column, source: Column, size: Column) -> Column:
    """One column for what the plan knows of a row, null or not, so that join and window share a shuffle."""
    return F.md5(F.to_json(F.struct(doc_id.cast("string").alias("a"), source.cast("string").alias("b"), size.cast("long").alias("c"))))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with their columns; documents of size 0 go.

    Rows that the plan cannot tell apart (one id or none, one source, one size) are numbered by a
    hash of their text, and the plan's copies are dealt out in that order, the largest first, so the words
    of a source are those planned. Their columns lie in a struct meanwhile, so names cannot clash.
    """
    each = [F.count(F.when(F.col("copies") == k, 1)) for k in range(MOST, 0, -1)]
    planned = (plan(docs).where("copies > 0").withColumn("key", _key(F.col("doc_id"), F.col("source"), F.col("size")))
               .groupBy("key").agg(F.array(*each).alias("rows")))
    size = F.size(rules.words_of(F.col("text")))
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    packed = docs.select(row.alias("row"), _key(F.col("doc_id"), F.col("source"), size).alias("key"), F.xxhash64("text").alias("spread"))
    number = F.row_number().over(Window.partitionBy("key").orderBy("spread"))
    # The first rows get MOST copies, as many as the plan has of those, then fewer.
    copies = F.aggregate("rows", F.struct(F.lit(0).cast("long").alias("before"), F.lit(0).alias("place"), F.lit(0).alias("copies")),
                         lambda state, n: F.struct(
                             (state["before"] + n).alias("before"), (state["place"] + 1).alias("place"),
                             F.when((state["before"] < F.col("number")) & (F.col("number") <= state["before"] + n),
                                    F.lit(MOST) - state["place"]).otherwise(state["copies"]).alias("copies")),
                         lambda state: state["copies"])
    dealt = packed.join(planned, "key").withColumn("number", number).select("row", copies.alias("copies")).where("copies > 0")
    return dealt.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
