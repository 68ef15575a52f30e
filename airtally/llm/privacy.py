"""Personal data: base patterns, then terms that reveal a protected entity.

Emails, addresses, card and phone numbers are found by expression and checked. Each found value is
a protected entity. From the corpus it is estimated how strongly a term of the same document reveals it: the
pointwise mutual information of entity and term, as a share of the entity's own information. Terms
above the first disclosure threshold are generalised, above the second removed, in
the documents that hold the entity. Pairs of one document count too; the shares are smoothed.

Everything is DataFrame expressions. ``spans`` holds ``email, ip, card, phone`` in that order, then
``generalise`` and ``remove``; positions are code points, ends exclusive.

Cases: a null text is empty and has no span; each input row gives one row, repeated rows
included (each counts as a document); null ids are kept; without entities there are no terms; an empty
table gives an empty result. ``find`` reads ``doc_id`` and ``text`` only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.llm.rules import _let
from airtally.llm.secrets import joined_spans
from airtally.session import written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "generalise", "remove")
#: Weight, in documents, of the entity's share of all documents where its share among those
#: with a term is estimated: a term of few documents is held a little nearer to chance.
PRIOR = 0.5
#: Shares of an entity's information from which a term is generalised and removed.
GENERALISE, REMOVE = 0.75, 0.95
#: A term in this share of the documents, and in so many, is common: known to every task.
COMMON_SHARE, COMMON_LEAST = 0.001, 32
#: A term.
TERM = "[\\p{L}\\p{N}_]++"

# The expressions find what the plain ones (see the tests) find, in linear time: a run that fails
# at its start fails at each later place too, so only run starts and the end of the last
# match are tried, and repeats never give back.
PATTERNS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(number: Column) -> Column:
    """Whether the digits, every second from the right doubled, add up to a multiple of ten."""
    def part(back: Column, i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return digit - F.when(digit > 9, 9).otherwise(0)

    return _let(F.reverse(number), lambda back: F.aggregate(
        F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda total, i: total + part(back, i)) % 10 == 0)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, "\\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
        "^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")),
    "card": lambda m: F.when(F.length(_digits(m)).between(14, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}


def placed(text: Column, pattern: str) -> Column:
    """(start, end, value) of every match, leftmost and without overlap.

    The lengths of the pieces between the matches are added up in doubling steps.
    """
    def sums(lengths: Column) -> Column:
        steps = F.filter(F.array([F.lit(1 << k).cast("int") for k in range(31)]), lambda s: s < F.size(lengths))
        return F.aggregate(steps, lengths, lambda total, step: F.transform(
            total, lambda x, i: x + F.coalesce(F.get(total, i - step), F.lit(0).cast("long"))))

    def starts(pieces: Column, matches: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: (F.length(F.get(pieces, i)) + F.when(
            i > 0, F.length(F.get(matches, i - 1))).otherwise(0)).cast("long"))
        return _let(sums(lengths), lambda at: F.transform(matches, lambda m, i: F.struct(
            F.get(at, i).alias("start"), (F.get(at, i) + F.length(m)).alias("end"), m.alias("value"))))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: _let(
        F.split(text, pattern, -1), lambda pieces: starts(pieces, matches)))


def _found(text: Column) -> Column:
    """All base spans, sorted by start and then kind: (start, place, kind, end)."""
    def of(kind: str) -> Column:
        spans = F.transform(F.filter(placed(text, PATTERNS[kind]), lambda m: VALID[kind](m["value"])), lambda m: F.struct(
            m["start"].alias("start"), F.lit(BASE.index(kind)).alias("place"), F.lit(kind).alias("kind"), m["end"].alias("end")))
        possible = F.contains(text, F.lit(_HINTS[kind])) & (F.lit(kind == "email") | text.rlike("[0-9]"))
        return F.when(possible, spans).otherwise(F.array().cast(
            "array<struct<start:bigint,place:int,kind:string,end:bigint>>"))

    return F.array_sort(F.concat(*map(of, BASE)))


def _base(docs: DataFrame) -> DataFrame:
    """(doc_id, key, found, entities, held) of every row: spans, hashes of the distinct values found, and
    the text where there are any."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", "text").alias("key")).select(
        "doc_id", "text", "key", _found(F.col("text")).alias("found"))
    entity = F.transform("found", lambda s: F.xxhash64(F.lower(F.substring(
        F.col("text"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))), s["kind"]))
    return rows.select("doc_id", "key", "found", F.array_distinct(entity).alias("entities"),
                       F.when(F.size("found") > 0, F.col("text")).alias("held"))


def _entities(base: DataFrame, n: Column) -> DataFrame:
    """(key, rows, group, of_entity, most): the groups of entities of each text that has any.

    Entities of the same documents meet the same terms equally often and are one group. ``rows``
    counts the equal rows of the text. A term of more than ``most`` documents cannot tell on the group:
    its disclosure is under GENERALISE even where it is in all of the group's documents.
    """
    texts = base.where(F.size("entities") > 0).groupBy("key").agg(F.count("*").alias("rows"), F.first("entities").alias("entities"))
    held = written(texts.select("key", "rows", F.explode("entities").alias("entity")), "entities")
    of_entity = held.groupBy("entity").agg(F.sum("rows").alias("of_entity"), F.bit_xor("key").alias("one"),
                                           F.bit_xor(F.xxhash64("key")).alias("two"))
    share = F.col("of_entity") / n
    most = (F.col("of_entity") + PRIOR * share) / F.pow(share, F.lit(1 - GENERALISE)) - PRIOR
    # The one document more is for rounding.
    known = of_entity.where(F.col("of_entity") < n).select(
        "entity", "of_entity", F.xxhash64("of_entity", "one", "two").alias("group"), (F.ceil(most) + 1).alias("most"))
    return held.join(known, "entity").select("key", "rows", "group", "of_entity", "most").distinct()


def _terms(docs: DataFrame) -> DataFrame:
    """(term, of_term): the documents with each term anywhere."""
    found = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(F.lower(w)))
    return docs.select(F.explode(F.array_distinct(found)).alias("term")).groupBy("term").agg(F.count("*").alias("of_term"))


def _mentions(base: DataFrame, groups: DataFrame, terms: DataFrame, n: Column) -> DataFrame:
    """(key, term, of_term, start, end, free): where terms that can tell on an entity of their text are.

    ``free``: outside all base spans. Terms of many documents are known to every task (texts hold
    few of them distinct), so that most words are left out before the shuffle.
    """
    reach = groups.groupBy("key").agg(F.max("most").alias("most"))
    places = (base.where(F.col("held").isNotNull()).select("key", "found", "held").join(reach, "key")
              .select("key", "found", "most", F.explode(placed(F.col("held"), TERM)).alias("m")))
    free = ~F.exists("found", lambda s: (s["start"] < F.col("m.end")) & (s["end"] > F.col("m.start")))
    common = terms.where(F.col("of_term") >= F.greatest(n * COMMON_SHARE, F.lit(COMMON_LEAST))).select(
        F.col("term").alias("common"), F.col("of_term").alias("of_common"))
    places = (places.withColumn("term", F.xxhash64(F.lower("m.value"))).join(F.broadcast(common), F.col("term") == F.col("common"), "left")
              .where(F.col("of_common").isNull() | (F.col("of_common") <= F.col("most")))
              .select("key", "most", "term", F.col("m.start").alias("start"), F.col("m.end").alias("end"), free.alias("free")))
    return places.join(terms, "term").where(F.col("of_term") <= F.col("most")).select(
        "key", "term", "of_term", "start", "end", "free")


def disclosures(mentions: DataFrame, groups: DataFrame, n: Column) -> DataFrame:
    """(key, term, disclosure): the strongest disclosure of each term on an entity of its text.

    ``disclosure`` is log(p(e|t) / p(e)) / log(1 / p(e)) over document counts, with p(e) = n(e) / N and
    p(e|t) = (n(e,t) + PRIOR p(e)) / (n(t) + PRIOR). Entity and term meet in a document that holds
    both, however far apart; n(t) counts all documents with the term anywhere.
    """
    meets = written(mentions.select("key", "term", "of_term").distinct().join(groups, "key")
                    .where(F.col("of_term") <= F.col("most")).drop("most"), "meets")
    both = written(meets.groupBy("group", "term").agg(F.sum("rows").alias("both")), "both")
    share = F.col("of_entity") / n
    shared = F.log((F.col("both") + PRIOR * share) / ((F.col("of_term") + PRIOR) * share))
    return (meets.join(both, ["group", "term"]).select("key", "term", (shared / F.log(1 / share)).alias("disclosure"))
            .where(F.col("disclosure") >= GENERALISE).groupBy("key", "term").agg(F.max("disclosure").alias("disclosure")))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end) for every row."""
    base = written(_base(docs), "base")
    n = F.lit(float(max(base.count(), 1)))
    groups = written(_entities(base, n), "groups")
    mentions = written(_mentions(base, groups, written(_terms(docs), "terms"), n), "mentions")
    kind = F.when(F.col("disclosure") >= REMOVE, F.lit("remove")).otherwise(F.lit("generalise"))
    # Every place of a telling term is treated, by the strongest of the text's entities.
    extra = (mentions.where("free").select("key", "term", "start", "end").distinct()
             .join(disclosures(mentions, groups, n), ["key", "term"])
             .select("key", F.struct("start", F.when(F.col("disclosure") >= REMOVE, 5).otherwise(4).alias("place"),
                                     kind.alias("kind"), "end").alias("span"))
             .groupBy("key").agg(F.collect_list("span").alias("more")))
    spans = F.array_sort(F.concat("found", F.coalesce("more", F.array().cast(
        "array<struct<start:bigint,place:int,kind:string,end:bigint>>"))))
    return (base.select("doc_id", "key", "found").join(extra, "key", "left")
            .select("doc_id", F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                    s["end"].alias("end"))).cast(_SPAN).alias("spans")))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(kind) for kind in BASE], F.sha2(joined_spans(base), 256).alias("base_sha256"),
                        joined_spans(F.col("spans")).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become the
    first one's mark."""
    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substring(text, state["at"].cast("int") + 1, (span["start"] - state["at"]).cast("int"))
        return F.struct(F.when(fresh, F.concat(state["out"], before, F.lit("["), F.upper(span["kind"]), F.lit("]")))
                        .otherwise(state["out"]).alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    return F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), step,
                       lambda state: F.concat(state["out"], F.substring(text, state["at"].cast("int") + 1, F.length(text))))
