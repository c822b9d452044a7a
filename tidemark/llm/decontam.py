"""Benchmark decontamination with a distributed positional inverted index (DataFrame functions only).

Test items become windows of `size` consecutive words. The corpus is counted once for the terms of the test items; the
rarest terms of each window are its *anchors*. The index is stored: for each document its number of words and the postings
(term, position, a set of the neighbouring terms) of the anchors, so its lists are the shortest ones that can find every window. A
phrase match is a start at which the offset-adjusted lists of all of a window's anchors meet and the neighbours of the
rarest one are the window's words. A proximity match only asks that enough of the window's words lie near one of its
anchors, even where words are missing that the whole corpus lacks. A window has as many anchors as words may differ, and
one more (see differ()), so some anchor is always there: `size` consecutive words of which no more differ are never
missed. Where no word may differ (a near_share of 1) one anchor finds all.

The set of neighbours is folded to twice 64 bits. A word that is missing takes at most one bit of each away, so a posting and a window
that lack more bits than words may differ are no match. All others are decided by the neighbouring words themselves, which
are taken from the texts of those documents again.

Nulls: a null text has no words, an item with a null id or without words takes no part. Repeated items and
repeated documents change nothing for the others. Ties between equally rare terms go to the smaller term, and of a term that
a window has twice the first place counts. Texts of any length are indexed whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import SMALL_IDS, cut, fewer, keyed, load, null_safe, without
from .runs import discard, stored

#: ASCII that parts words, and capitals that are folded.
PARTS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most terms that are written into a plan, and that are sent to every executor, at about 40 bytes each; with more, joins
#: shuffle instead.
LISTED, SMALL_TERMS = 5_000, 50_000


def words(text: Column) -> Column:
    """Maximal runs of ASCII letters, digits and all characters from 0x80, with A-Z lower-cased."""
    plain = F.translate(text, PARTS + CAPITALS, " " * len(PARTS) + CAPITALS.lower())
    return F.filter(F.split(plain, " "), lambda w: w != "")


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """win array<string>, items array<string>: each distinct window and the items that have it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.coalesce(F.col("text"), F.lit(""))).alias("w"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("w") > 0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("win"))
    return each.groupBy("win").agg(F.collect_set("item_id").alias("items"))


def _join_terms(rows: DataFrame, terms: DataFrame, n: int, how: str) -> DataFrame:
    return rows.join(F.broadcast(terms) if n <= SMALL_TERMS else terms, "term", how)


def differ(size: int, near_share: float) -> int:
    """How many of `size` words may differ in a proximity match."""
    return size - math.ceil(size * near_share)


def bits(terms: Column) -> Column:
    """A set of terms, folded to twice 64 bits by different bits of their hashes: struct<a, b>."""
    one = lambda t, by: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(F.xxhash64(t), by).bitwiseAND(63).cast("int"))
    fold = lambda by: F.aggregate(terms, F.lit(0).cast("long"), lambda m, t: m.bitwiseOR(one(t, by)))
    return F.struct(fold(0).alias("a"), fold(6).alias("b"))


def anchors(docs: DataFrame, wins: DataFrame, most: int, near_share: float) -> tuple[DataFrame, int]:
    """wid, win, items, term, off, rank, of, bits, least, spare: up to `most` rarest terms of each window, by how often all documents
    have them, from rank 0; of: how many it has, negative where the corpus lacks one of its terms, so that it can't occur
    whole; bits of its terms; least: how many of them a match has; spare: how
    many it may lack. Windows of which the corpus has fewer can't match and
    are left out. Also the number of different terms."""
    terms = wins.select(F.explode("win").alias("term")).distinct()
    n = terms.count()
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    counts = _join_terms(tokens, terms, n, "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = wins.select("win", "items", F.posexplode("win").alias("off", "term")).groupBy("win", "items", "term").agg(F.min("off").alias("off"))
    found = _join_terms(each, counts, n, "left").groupBy("win", "items").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "off"))).alias("a"))
    there, least = F.filter("a", lambda x: x["n"] > 0), F.ceil(F.size("a") * F.lit(near_share)).cast("int")
    rare = found.select(F.monotonically_increasing_id().alias("wid"), "win", "items", F.exists("a", lambda x: x["n"] == 0).alias("lacks"),
                        bits(F.col("a.term")).alias("bits"), least.alias("least"), (F.size("a") - least).alias("spare"), there.alias("a")).where(F.size("a") >= F.col("least"))
    rare = rare.withColumn("a", F.slice("a", 1, most))
    rare = cut(fewer(rare.select("wid", "win", "items", "bits", "least", "spare", F.when(F.col("lacks"), -F.size("a")).otherwise(F.size("a")).alias("of"), F.posexplode("a").alias("rank", "p")).select(
        "wid", "win", "items", "bits", "least", "spare", "of", "rank", "p.term", "p.off")))
    return rare, rare.select("term").distinct().count()


def _near(i: Column, reach: int) -> Column:
    """Of words w: the up to `reach` before place i, the word there and the up to `reach` after it."""
    return F.slice("w", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1)


def index(docs: DataFrame, terms: list[str] | DataFrame, n: int, reach: int) -> DataFrame:
    """doc_id, th, n_words, posts: a row for each document, with the postings of the n `terms`: array<struct<term, pos, beside>>.
    beside: the bits of the up to `reach` terms before, the term itself and the up to `reach` after it. Stored."""
    d = docs.select("doc_id", "th", words(F.col("text")).alias("w"))
    if isinstance(terms, list):
        places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get(F.col("w"), i).isin(terms))
        places = F.when(F.size("w") > 0, places) if terms else F.lit(None).cast("array<int>")
    else:
        pos = _join_terms(d.select("doc_id", "th", F.posexplode("w").alias("pos", "term")), terms, n, "left_semi")
        d, places = null_safe(d, pos.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("places"))), F.col("places")
    post = lambda i: F.struct(F.get(F.col("w"), i).alias("term"), i.alias("pos"), bits(_near(i, reach)).alias("beside"))
    return stored(d.select("doc_id", "th", F.size("w").cast("long").alias("n_words"), F.transform(places, post).alias("posts")), few=True)


def _neighbours(docs: DataFrame, lists: DataFrame, rare: DataFrame, n: int, reach: int) -> DataFrame:
    """doc_id, th, term, pos, at, near: of the postings that may match one of their term's windows, the neighbouring terms,
    in which the term itself has place `at`."""
    posts = lists.select("doc_id", "th", F.explode("posts").alias("p")).select("doc_id", "th", "p.*")
    may = _join_terms(posts, rare.select("term", "bits", "spare").distinct(), n, "inner")
    for x in "ab":
        may = may.where(F.bit_count(F.col(f"bits.{x}").bitwiseAND(F.bitwise_not(f"beside.{x}"))) <= F.col("spare"))
    may = cut(fewer(may.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("places"))))
    ids = may.select("doc_id", "th")
    some = null_safe(docs, F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "left_semi")  # only their texts can be shuffled
    each = null_safe(some, may, "inner").select("doc_id", "th", "places", words(F.col("text")).alias("w"))
    post = lambda i: F.struct(F.get(F.col("w"), i).alias("term"), i.alias("pos"), F.least(i, F.lit(reach)).alias("at"), _near(i, reach).alias("near"))
    return each.select("doc_id", "th", F.explode(F.transform("places", post)).alias("p")).select("doc_id", "th", "p.*")


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, near_share: float = 0.8, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """doc_id, th, items, start, length, exact: where windows of the test items occur; and the index. most: anchors of a
    window, if not as many as find all matches.
    exact: the window's words stand there in order; else at least `near_share` of its distinct words lie
    within `size` - 1 places of one of its anchors (a proximity match)."""
    rare, n = anchors(docs, windows(benchmark, size), differ(size, near_share) + 1 if most is None else most, near_share)
    terms = rare.select("term").distinct()
    lists = index(docs, [r[0] for r in terms.collect()] if n <= LISTED else terms, n, size - 1)
    both = _join_terms(_neighbours(docs, lists, rare, n, size - 1), rare, n, "inner")
    begin = F.col("at") - F.col("off")
    same = (begin >= 0) & (F.slice("near", F.greatest(begin, F.lit(0)) + 1, F.size("win")) == F.col("win"))
    close = F.size(F.array_intersect("near", "win")) >= F.col("least")
    here = both.select("doc_id", "th", "wid", "items", (F.col("pos") - F.col("off")).alias("start"), F.size("win").alias("length"), "of", "rank",
                       F.when(F.col("rank") == 0, same).alias("same"), close.alias("close")).where("close or same")
    # the lists of a window's anchors meet at a start that each of them has
    met = here.groupBy("doc_id", "th", "wid", "start").agg(F.first("items").alias("items"), F.first("length").alias("length"), F.first("of").alias("of"),
                                                            F.size(F.collect_set("rank")).alias("lists"), F.bool_or("same").alias("same"))
    return met.select("doc_id", "th", "items", "start", "length", (F.coalesce("same", F.lit(False)) & (F.col("lists") == F.col("of"))).alias("exact")), lists


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, near_share: float = 0.8, most: int | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, th, n_words, spans array<struct<start,length>> of exact matches,
    items array<string> sorted, near_items array<string>: items with a proximity match, sorted."""
    found, lists = matches(keyed(docs), benchmark, size, near_share, most)
    by_doc = found.groupBy("doc_id", "th").agg(
        F.collect_set(F.when(F.col("exact"), F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("exact"), F.col("items")))))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("near_items"))
    return null_safe(lists.select("doc_id", "th", "n_words"), by_doc)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of a test item occurs: no word may differ."""
    found, lists = matches(keyed(docs), benchmark, size, near_share=1.0)
    out = without(docs, found.where("exact"))
    discard(lists)
    return out


def op4_decontam(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    none = F.col("spans").isNull() | (F.size("spans") == 0)
    n_hit = F.when(none, F.lit(0)).otherwise(F.size(hit)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return fewer(out).select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS k FROM bw),
dw AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS s FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
