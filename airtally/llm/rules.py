"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio with a fixed threshold.

Whole words and pairs of neighbouring words are hashed into buckets, each kind into its half of
them. Two multinomials over the buckets are estimated, one from a trusted target (all documents
labelled good) and one from the whole corpus. A document's score is the mean over its n-grams of
the log of the ratio of the two; documents below the threshold are rejected. Everything is
DataFrame expressions: counting is one grouped aggregation into a fixed number of buckets,
scoring happens within the row.

Cases: null or empty text has no words, fails the base rules and scores 0; each input row gives
one row, repeated rows and null ids included; a text of any length is read whole; a score equal
to the threshold is kept; an id labelled good several times counts once, an id labelled both good
and bad counts as good; without target rows (no labels, empty table) all ratios are 0 and only
the base rules decide. ``decided`` reads ``doc_id`` and ``text`` only and counts every row;
``kept_documents``, whose copies a later stage removes, counts each different text once, so that a
text is not rejected for having copies. It keeps the documents' columns and adds none, so names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of the hashed n-grams.
BUCKETS = 1 << 16
#: Bitmaps of 4 KB with the target's ids that are broadcast at most (64 MB).
MOST_MAPS = 1 << 14
#: Mean log ratio (in nats per n-gram) below which a document is rejected. A word that only an
#: unlabelled document holds has log(PRIOR / (PRIOR + share)): with up to half of the corpus in the
#: target, such words alone reject nothing.
THRESHOLD = -0.25
#: Occurrences added to a bucket's target count and to what the corpus would make it: rare n-grams
#: stay near a ratio of 1, whatever the corpus' size.
PRIOR = 2.0
#: Log ratios are kept as whole thousandths.
UNIT = 1000.0

_SPACE = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE, -1), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _neighbours(words: Column, n: int, combine: Callable[..., Column]) -> Column:
    """``combine`` of every n neighbours of an array; none where it is shorter."""
    firsts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(firsts, lambda word, i: combine(word, *[F.get(words, i + k) for k in range(1, n)]))


def _bucket(n: int, *words: Column) -> Column:
    """Bucket of an n-gram of words: single words in the lower half, pairs in the upper one."""
    # Half the number of buckets is a power of two.
    return (F.xxhash64(*words).bitwiseAND(F.lit(BUCKETS // 2 - 1)) + F.lit((n - 1) * BUCKETS // 2)).cast("int")


def _buckets(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    return F.concat(F.transform(words, lambda word: _bucket(1, word)),
                    _neighbours(words, 2, lambda *pair: _bucket(2, *pair)))


def _bucket_rows(words: DataFrame) -> DataFrame:
    """(target, bucket) of each n-gram of the texts' ``words``.

    The same n-grams as ``_buckets``: one row for each word first, so the rest is compiled code.
    """
    following = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    each = (words.select("target", "words", following.alias("following"))
            .select("target", F.explode(F.arrays_zip("words", "following")).alias("at")))
    word, after = F.col("at.words"), F.col("at.following")
    found = F.array(_bucket(1, word), F.when(after.isNotNull(), _bucket(2, word, after)))
    return each.select("target", F.explode(found).alias("bucket")).where(F.col("bucket").isNotNull())


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are sorted with their places, so equal ones lie side by side; then each repeated window
    counts the words up to the next repeated window, three at most.
    """
    def repeated(rows: Column) -> Column:
        return F.filter(F.transform(rows, lambda row, i: F.when(
            (F.get(rows, i - 1)["h"] == row["h"]) | (F.get(rows, i + 1)["h"] == row["h"]), row["i"])),
            lambda place: place.isNotNull())

    def covered(places: Column) -> Column:
        ends = F.transform(places, lambda place, k: F.least(
            F.coalesce(F.get(places, k + 1) - place, F.lit(3)), F.lit(3)).cast("long"))
        return F.aggregate(ends, F.lit(0).cast("long"), lambda total, n: total + n)

    def count(windows: Column) -> Column:
        # sort_array compares values directly; array_sort evaluates an expression per comparison.
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # Most texts have no repeated window: a set of numbers shows that without sorting.
        return F.when(F.size(windows) != F.size(F.array_distinct(windows)),
                      _let(placed, lambda rows: _let(F.sort_array(repeated(rows)), covered))).otherwise(
            F.lit(0).cast("long"))

    return _let(_neighbours(words, 3, lambda *w: F.xxhash64(*w)), count)


def target_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the documents labelled good, once each."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def _marked(texts: DataFrame, labels: DataFrame, most_maps: int = MOST_MAPS) -> DataFrame:
    """The texts with ``target``: 1 for documents labelled good, 0 for others.

    Whole-number ids fit into bitmaps of 4 KB for 32,768 ids. Their number is counted, and up to
    ``most_maps`` are broadcast, so that no text is shuffled; beyond, or with other ids, the texts are
    joined with the ids by whatever join Spark chooses.
    """
    ids, at = target_ids(labels), F.col("doc_id")
    if all(isinstance(df.schema["doc_id"].dataType, (T.LongType, T.IntegerType)) for df in (texts, ids)):
        block = F.bitmap_bucket_number(at.cast("long"))
        if ids.select(block.alias("block")).distinct().count() <= most_maps:
            place = F.bitmap_bit_position(at.cast("long"))
            maps = ids.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits"))
            byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
            bit = F.getbit(byte.cast("int"), (place % 8).cast("int")).cast("int")
            return texts.join(F.broadcast(maps), block == F.col("block"), "left").select(
                F.coalesce(bit, F.lit(0)).alias("target"), "text")
    good = ids.withColumn("target", F.lit(1))
    # Null ids join nothing, so they stay out of the join and off a single key.
    known = texts.where(at.isNotNull()).join(good, "doc_id", "left")
    return known.select(F.coalesce("target", F.lit(0)).alias("target"), "text").unionByName(
        texts.where(at.isNull()).select(F.lit(0).alias("target"), "text"))


def log_ratios(docs: DataFrame, labels: DataFrame, once: bool = False) -> list[int]:
    """The log ratio of target to corpus of every bucket, in thousandths.

    All documents are counted, with those labelled good as target; counts are combined per task and
    come down to one row per bucket. With ``once`` equal texts count as one, good if one of them is.
    """
    marked = _marked(docs.select("doc_id", "text"), labels)
    if once:
        marked = marked.groupBy("text").agg(F.max("target").alias("target"))
    parts = marked.select("target", words_of(F.col("text")).alias("words"))
    counted = (_bucket_rows(parts).groupBy("bucket")
               .agg(F.count("*").alias("corpus"), F.sum("target").alias("target")).collect())
    corpus, target = sum(row["corpus"] for row in counted), sum(row["target"] for row in counted)
    out = [0] * BUCKETS
    if not target:
        return out
    for row in counted:
        expected = row["corpus"] * target / corpus
        out[row["bucket"]] = round(UNIT * math.log((row["target"] + PRIOR) / (expected + PRIOR)))
    return out


def _counts(ratios: list[int]) -> list[Column]:
    """Columns from ``text`` and ``words``."""
    text, words = F.coalesce(F.col("text"), F.lit("")), F.col("words")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    # One constant array of the model's numbers, a bounded part of the plan.
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    grams = _let(_buckets(words), lambda b: F.aggregate(
        b, F.lit(0).cast("long"), lambda total, i: total + F.get(model, i),
        lambda total: F.when(F.size(b) > 0, total / F.lit(UNIT) / F.size(b)).otherwise(0.0)))
    return [F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            _let(lines, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            grams.alias("score")]


def _decide(docs: DataFrame, ratios: list[int], keep: list[str], threshold: float) -> DataFrame:
    """The kept columns with the counts and decisions."""
    # ``words`` is read by several columns, so it stays a projection of its own.
    found = (docs.select(*keep, "text", words_of(F.col("text")).alias("words"))
             .select(*keep, *_counts(ratios)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def decided(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and decisions of every document."""
    return _decide(docs, log_ratios(docs, labels), ["doc_id"], threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, with their columns."""
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document"), "text")
    # The partition number makes the column one that Spark does not move a filter through: a filter
    # moved below the projections would compute words and hashes again for each element.
    found = _decide(packed, log_ratios(docs, labels, once=True), ["document"], threshold).select(
        "document", (F.col("kept") & (F.spark_partition_id() >= 0)).alias("stays"))
    return found.where("stays").select("document.*")
