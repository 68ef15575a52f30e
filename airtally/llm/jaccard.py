"""N-gram Jaccard join with prefix filters under several global token orders.

A document's tokens are the hashes of its distinct word shingles. Under any global order of
the tokens two sets with a Jaccard similarity of ``percent`` or more share a number of
tokens among their first few (the prefix). Candidates come from the prefixes under the first order;
they must then share prefix tokens under the second and third order too before the whole sets are
compared. Orders are hashes, with tokens frequent in the corpus' prefixes moved to the end.

Near-copy groups are not expanded into pairs. Equal sets are one node. Each shared token first
compares its nodes with its leader only, the node with the fewest tokens of its own; what links
becomes a component. Then only pairs across different components, of a fitting size and sharing as
many prefix tokens as similar sets must, are compared, so no link between different
components is missed. Tokens of near-copy groups and common passages are ordered last, so a
copy's own changes fill its prefix and rule out distant copies without a comparison.

Cases: null or empty text, or text without words: no shingles, linked with nothing (its own
component); a row without doc_id links like any other and gets the smallest doc_id it reaches, null if
there is none; rows of one doc_id are one document and linked; repeated rows each get a row;
an empty table gives an empty result. Very long texts are read whole. ``components`` reads ``doc_id`` and
``text`` only. Ids are below ``NO_ID``; numbers from there on stand for sets that no row with an id has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm import common, graph, words
from airtally.session import discard, written

#: Words of a shingle, and the least similarity in percent.
WIDTH, PERCENT = 4, 85
#: Prefix tokens that similar sets must share at least (fewer for tiny sets).
SHARED = 3
#: A prefix token in more documents than this is frequent; so many frequent tokens are ordered last.
FREQUENT, MOST_FREQUENT = 32, 1_000_000
#: Share of frequent tokens in a prefix from which on all tokens of the document are counted.
HOT_SHARE = 0.1
#: Nodes of sets without an id are numbered by their hash from here on, after all ids.
NO_ID = 1 << 62
#: Node ids up to this number are broadcast to pick texts; above it they are joined by shuffle.
BROADCAST_IDS = 1_000_000


def _least_common(n: Column | int, percent: int) -> Column | int:
    """Tokens that a set of n shares with any similar set: percent of n, rounded up."""
    if isinstance(n, int):
        return -(-percent * n // 100)
    return F.ceil(n * F.lit(percent) / F.lit(100)).cast("long")


def _tokens(text: str, width: int) -> np.ndarray:
    lowered = text.encode("utf-8").lower()  # bytes: only A-Z change
    return words.shingles(np.frombuffer(lowered, np.uint8), width)


def _among(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def _set_id(tokens: np.ndarray) -> bytes:
    return hashlib.md5(tokens.tobytes()).digest()


def _node(set_id: bytes) -> int:
    """The node of a set that no row with an id has."""
    return NO_ID | int.from_bytes(set_id[:8], "little") >> 2


def _place(prefix_tokens: np.ndarray, frequent: np.ndarray) -> int:
    """A number that grows with the place of the prefix' last token in the first order."""
    if not len(prefix_tokens):
        return 0
    return int(_among(prefix_tokens[-1:], frequent)[0]) << 62 | int(prefix_tokens[-1]) >> 2


def prefix(tokens: np.ndarray, order: int, frequent: np.ndarray, percent: int, shared: int) -> np.ndarray:
    """The first tokens of the set under one of the global orders.

    Sets with at least ``least`` common tokens share ``m`` of them among their first
    ``n - least + m``.
    """
    least = _least_common(len(tokens), percent)
    length = len(tokens) - least + min(shared, least)
    keys = tokens if order == 0 else words.mixed(tokens + np.uint64(order * 0x9E3779B97F4A7C15 % (1 << 64)))
    if len(frequent):
        return tokens[np.lexsort((keys, _among(tokens, frequent)))[:length]]
    return tokens[np.argsort(keys, kind="stable")[:length]]


def _flat(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays or [np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def frequent_tokens(docs: DataFrame, width: int, percent: int, shared: int) -> np.ndarray:
    """The most frequent tokens, sorted: a bounded list for the orders.

    First the prefix tokens of all documents are counted, then all tokens of the documents
    with many frequent ones. The list only shapes the orders; results do not depend on it.
    """
    none = np.zeros(0, np.uint64)
    spark = docs.sparkSession.sparkContext

    def counted(of_set: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    found = [of_set(_tokens(text, width)) for text in common.texts_of(batch.slice(at, 1000))]
                    yield pa.RecordBatch.from_arrays([_flat(found).values], ["token"])

        top = (docs.select("text").mapInArrow(work, "token bigint").groupBy("token").count()
               .where(F.col("count") > FREQUENT).orderBy(F.desc("count"), "token").limit(MOST_FREQUENT)
               .select("token").toArrow())
        return np.sort(top.column("token").to_numpy().astype(np.int64).view(np.uint64))

    def first(tokens: np.ndarray) -> np.ndarray:
        return prefix(tokens, 0, none, percent, shared)

    start = counted(first)
    if not len(start):
        return start
    known = spark.broadcast(start)

    def hot(tokens: np.ndarray) -> np.ndarray:
        found = _among(first(tokens), known.value)
        return tokens if len(found) and found.mean() >= HOT_SHARE else tokens[:0]

    return np.union1d(start, counted(hot))


def _profiles(docs: DataFrame, frequent: np.ndarray, width: int, percent: int, shared: int) -> DataFrame:
    """(doc_id, n, set_id, own, last, prefix) of every row; ``last`` is the place of the prefix' end,
    ``own`` the node of the set should no row with an id have it."""
    shared_list = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [_tokens(text, width) for text in common.texts_of(part)]
                firsts = [prefix(s, 0, shared_list.value, percent, shared) for s in sets]
                set_ids = list(map(_set_id, sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(set_ids, pa.binary()), pa.array(list(map(_node, set_ids)), pa.int64()),
                     pa.array([_place(f, shared_list.value) for f in firsts], pa.int64()), _flat(firsts)],
                    ["doc_id", "n", "set_id", "own", "last", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id bigint, n bigint, set_id binary, own bigint, last bigint, prefix array<bigint>")


def _sets(docs: DataFrame, ids: DataFrame, frequent: np.ndarray, width: int, percent: int, shared: int) -> DataFrame:
    """(node, n, tokens, second, third) of the nodes: whole sets and the prefixes under the other
    orders. Texts without an id are looked at one of each, as only their sets tell their nodes."""
    shared_list = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [_tokens(text, width) for text in common.texts_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(_set_id(s)) if i is None else i for i, s in zip(part.column("doc_id").to_pylist(), sets)], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), _flat(sets),
                     *[_flat([prefix(s, order, shared_list.value, percent, shared) for s in sets]) for order in (1, 2)]],
                    ["node", "n", "tokens", "second", "third"])

    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    columns = "node bigint, n bigint, tokens array<bigint>, second array<bigint>, third array<bigint>"
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    known = rows.join(ids, F.col("doc_id") == F.col("node"), "left_semi").distinct().mapInArrow(work, columns)
    # Texts that differ may have one set.
    other = (rows.where(F.col("doc_id").isNull()).distinct().mapInArrow(work, columns)
             .join(ids, "node", "left_semi").dropDuplicates(["node"]))
    return known.unionByName(other)


def _linked(pairs: DataFrame, docs: DataFrame, frequent: np.ndarray, width: int, percent: int, shared: int) -> DataFrame:
    """The pairs (a, b) that are similar: filtered by the other orders, then compared whole."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidates")
    sets = written(_sets(docs, ids, frequent, width, percent, shared), "sets")
    left, right = sets.select([F.col(c).alias(f"{c}_a") for c in sets.columns]), sets.select(
        [F.col(c).alias(f"{c}_b") for c in sets.columns])
    both = (pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
            .where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")))
    common_tokens = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return (both.withColumn("common", common_tokens)
            .where(F.col("common") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))
            .select("a", "b").distinct())


def components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, shared: int = SHARED) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    members, labels = _linked_nodes(docs, width, percent, shared)
    reached = F.coalesce("label", "node")
    return (members.join(labels, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).when(reached < NO_ID, reached).alias("component_id")))


def _linked_nodes(docs: DataFrame, width: int, percent: int, shared: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, set_id, node) of every row, and (node, label) of the nodes that are linked."""
    args = (width, percent, shared)
    frequent = frequent_tokens(docs, *args)
    profiles = written(_profiles(docs, frequent, *args), "profiles")
    # Equal sets have equal prefixes, so any of them is the class's.
    classes = written(profiles.where(F.col("n") > 0).groupBy("set_id", "n", "last")
                      .agg(F.coalesce(F.min("doc_id"), F.min("own")).alias("node"), F.first("prefix").alias("prefix")), "classes")
    members = written(profiles.select("doc_id", "n", "set_id")
                      .join(classes.select("set_id", "node"), "set_id", "left"), "members")
    # Each set's prefix is in its class now.
    discard(profiles)
    meets = _meets(classes)
    discard(classes)

    leaders = meets.groupBy("token").agg(*[F.min_by(c, "own").alias(f"{c}_a") for c in ("node", "n")])
    stars = (meets.join(leaders, "token").where(F.col("node") != F.col("node_a"))
             .groupBy("node_a", "n_a", "node", "n").count()
             .where(_fits(F.col("n_a"), F.col("n"), percent)
                    & (F.col("count") >= F.least(F.lit(shared), _least_common(F.least("n_a", "n"), percent)))))
    stars = written(stars.select(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b"))
                    .distinct(), "stars")
    # Sets of one doc_id belong to one document.
    first = members.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    same = members.join(first.where(F.col("a") < F.col("b")).select("doc_id", "a"), "doc_id").select(
        "a", F.col("node").alias("b")).where(F.col("a") != F.col("b"))
    linked = written(_linked(stars, docs, frequent, *args).union(same).distinct(), "links")
    labels = graph.components(linked)

    across = written(_across(meets, labels, percent, shared).join(stars, ["a", "b"], "left_anti"), "pairs")
    if not across.isEmpty():
        more = _linked(across, docs, frequent, *args)
        labels = graph.components(linked.union(more))
    return members, labels


def _meets(classes: DataFrame) -> DataFrame:
    """(token, node, n, last, met, k, own): a row for each prefix token that several nodes have.

    ``met`` counts the node's rows here, ``k`` numbers them in the first order. ``own`` orders
    nodes by the share of their prefix that no other node has, a hash settling ties.
    """
    tokens = classes.select(
        "node", "n", "last", F.size("prefix").alias("length"), F.posexplode("prefix").alias("place", "token"))
    several = (tokens.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"))
               .where(F.col("low") < F.col("high")).select("token"))
    rows = tokens.join(several, "token")
    # A group is one set's prefix.
    one = Window.partitionBy("node", "n", "last")
    rows = (rows.withColumn("k", F.row_number().over(one.orderBy("place")) - 1)
            .withColumn("met", F.count("*").over(one)))
    share = F.floor((1 - F.col("met") / F.col("length")) * 1000).cast("long")
    own = F.shiftleft(F.greatest(share, F.lit(0)), 44).bitwiseOR(F.shiftrightunsigned(F.xxhash64("node"), 20))
    return written(rows.select("token", "node", "n", "last", "met", "k", own.alias("own")), "meets")


def _fits(n_a: Column, n_b: Column, percent: int) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def _needed(percent: int, shared: int) -> Column:
    """Prefix tokens that similar sets of columns ``_a`` and ``_b`` share.

    What they share beyond the prefix that ends first is at most the rest of that set.
    """
    def rest(side: str) -> Column:
        least = _least_common(F.col(f"n_{side}"), percent)
        return least - F.least(F.lit(shared), least)

    overlap = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9)).cast("long")
    return overlap - (F.when(F.col("last_a") < F.col("last_b"), rest("a"))
                      .when(F.col("last_a") > F.col("last_b"), rest("b")).otherwise(F.greatest(rest("a"), rest("b"))))


def _across(meets: DataFrame, labels: DataFrame, percent: int, shared: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share enough prefix tokens.

    A pair comes up at few of its common tokens; then the two lists of tokens are compared.
    Sizes meet in bands, as those of similar sets differ by at most one band and rounding.
    """
    known = (meets.join(labels, "node", "left")
             .select("token", "node", "n", "last", "met", "k", F.coalesce("label", "node").alias("component")))
    mixed = (known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where(F.col("low") < F.col("high")).select("token"))
    rows = written(known.join(mixed, "token"), "mixed").withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int"))
    names = ("node", "n", "last", "met", "k", "component")
    large = rows.select("token", "band", *[F.col(c).alias(f"{c}_a") for c in names])
    small = rows.select("token", F.explode(F.array("band", F.col("band") + 1, F.col("band") + 2)).alias("band"),
                        *[F.col(c).alias(f"{c}_b") for c in names])
    needed = _needed(percent, shared)
    # Sets that share ``needed`` of their met tokens share one among the first met - needed + 1.
    fits = ((F.col("component_a") != F.col("component_b")) & _fits(F.col("n_a"), F.col("n_b"), percent)
            & ((F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b"))))
            & (F.col("k_a") + needed <= F.col("met_a")) & (F.col("k_b") + needed <= F.col("met_b")))
    sides = ["node_a", "n_a", "last_a", "node_b", "n_b", "last_b"]
    pairs = large.join(small, ["token", "band"]).where(fits).select(sides).distinct()
    lists = meets.groupBy("node", "n", "last").agg(F.collect_list("token").alias("tokens"))
    for side in "ab":
        pairs = pairs.join(lists.select([F.col(c).alias(f"{c}_{side}") for c in lists.columns]),
                           [f"node_{side}", f"n_{side}", f"last_{side}"])
    pairs = pairs.where(F.size(F.array_intersect("tokens_a", "tokens_b")) >= needed)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, one row of each group: that of the smallest id.

    Of several rows with the group's id, or of a group without any id, the first as JSON stays. Rows without
    words have no copies: all without an id stay, one of each id. All columns are kept, of any type.
    """
    members, labels = _linked_nodes(docs, width, percent, SHARED)
    reached = F.coalesce("label", "node")
    groups = members.join(labels, "node", "left").select(
        "doc_id", "n", "set_id", F.when(F.col("n") > 0, reached).otherwise(F.col("doc_id")).alias("group"))
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    packed = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"))

    keep = groups.where(F.col("doc_id") == F.col("group")).select(F.col("doc_id").alias("id")).distinct()
    known = (packed.where(F.col("id").isNotNull()).join(keep, "id", "left_semi")
             .groupBy("id").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [_tokens(text, width) for text in common.texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([_set_id(t) for t in tokens], pa.binary()), pa.array([len(t) for t in tokens], pa.int64()),
                                              batch.column("text")], ["set_id", "n", "text"])

    without = packed.where(F.col("id").isNull())
    texts = without.select(F.col("row.text").alias("text")).distinct().mapInArrow(sets, "set_id binary, n bigint, text string")
    alone = groups.where(F.col("doc_id").isNull() & (F.col("group") >= NO_ID)).select("set_id", "group").distinct()
    unknown = (without.join(texts, F.col("row.text").eqNullSafe(F.col("text"))).join(alone, "set_id", "left")
               .where((F.col("n") == 0) | F.col("group").isNotNull()))
    one = (unknown.where("n > 0").groupBy("group").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))
    return known.unionByName(one).unionByName(unknown.where("n = 0").select("row.*"))
