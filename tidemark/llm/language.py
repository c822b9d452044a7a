"""Language of web pages by Bayesian fusion of evidence.

Four pieces of evidence: the visible text (a naive Bayes model over hashed character pieces, tempered, since
neighbouring pieces aren't independent), the language that the markup declares, the last label of the address, and
what else the host has. All tables come from grouped aggregation over all pages: the texts' probabilities are
summed by declared language, by last label, by domain and by host, so pages without evidence weigh little. A host's
prior is smoothed with its domain's, that with its top-level domain's, and that with the whole; a page's own share
is taken out first.

The text model knows every language that a document has. It is fitted on a bounded sample of each: TRAIN_EACH
documents, those with the least hash of doc_id among texts of at most TRAIN_CHARS characters; longer texts, by their
beginning, and ones without a doc_id only fill up.

Null or empty pages have no text evidence; null addresses have no host and label, and no declaration is a value of
its own. Repeated rows count as pages. Pages of any length are read whole, in time that grows with their length, whatever
they hold. Of languages with equal scores the first by name is taken. Without labelled documents lang is null.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SMALL_IDS, cut, frugal, load, mix64, slices
from .runs import SMALL_BYTES

TRAIN_EACH, TRAIN_CHARS = 600, 20_000
#: Hashed character pieces of 1 to 3 characters; how many independent pieces a text counts as at most.
BUCKETS, MOST_PIECES = 1 << 15, 60.0
#: Pages that a smoothing prior weighs as much as.
STRENGTH = 5.0

_OPEN = re.compile(r"(?i)<(script|style|noscript)\b")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript")}
_HTML, _LANG = re.compile(r"(?i)<html\b"), re.compile(r"(?i)\blang\s*=\s*[\"']?([a-z]{2,3})\b")


def visible(page: str) -> str:
    """The text between tags, without scripts, styles and comments. What isn't closed is no comment or script; a last tag
    that isn't closed is text. No part of the page is searched twice for the same end."""
    out, at, missing = [], 0, set()
    while (begin := page.find("<", at)) >= 0:
        out.append(page[at:begin])
        end = -1
        if page.startswith("<!--", begin) and "-->" not in missing:
            end = page.find("-->", begin + 4)
            if end < 0:
                missing.add("-->")
            else:
                end += 3
        elif (m := _OPEN.match(page, begin)) and (name := m[1].lower()) not in missing:
            if close := _CLOSE[name].search(page, m.end()):
                end = close.end()
            else:
                missing.add(name)
        if end < 0:
            end = page.find(">", begin) + 1
            if not end:
                at = begin
                break
        out.append(" ")
        at = end
    return html.unescape("".join([*out, page[at:]]))


def declared(page: str) -> str | None:
    """The language that the first html tag with one declares."""
    at = 0
    while m := _HTML.search(page, at):
        end = page.find(">", m.end())
        end = len(page) if end < 0 else end
        if said := _LANG.search(page, m.end(), end):
            return said[1].lower()
        at = end
    return None


def pieces(text: str) -> np.ndarray:
    """Hashed pieces of 1 to 3 characters of the lower-cased text, with runs of white space as one space."""
    c = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    for n in (1, 2, 3):
        h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)
        out.append(mix64(h) >> np.uint64(64 - BUCKETS.bit_length() + 1))
    return np.concatenate(out).astype(np.int64)


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """One language's pieces, as little-endian 64-bit numbers."""
    counts = np.zeros(BUCKETS, "<i8")
    for t in rows["text"]:
        counts += np.bincount(pieces(t), minlength=BUCKETS)
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "counts": [counts.tobytes()]})


def text_evidence(model: np.ndarray, text: str) -> np.ndarray:
    """Tempered log likelihood of the text in each language, the largest 0."""
    if not len(model) or not text.strip():
        return np.zeros(len(model))
    p = pieces(text)
    total = model @ np.bincount(p, minlength=BUCKETS)
    total = total / len(p) * min(len(p), MOST_PIECES)
    return total - total.max()


def _model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and the log probability of each piece in each language."""
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    some = some.withColumn("_last", F.col("doc_id").isNull() | (F.length("text") > TRAIN_CHARS)).withColumn("text", F.substring("text", 1, TRAIN_CHARS))
    some = some.withColumn("_h", F.when(F.col("_last"), F.xxhash64("doc_id", "text")).otherwise(F.xxhash64("doc_id")))
    # only about twice as many rows as are wanted go on, from all partitions together
    sizes = some.groupBy("lang").agg(F.count_if(~F.col("_last")).alias("short"), F.count_if("_last").alias("long")).collect()
    least = lambda n, want: (1 << 63) - 1 if n <= 2 * want else int(-(1 << 63) + 2 * want / n * (1 << 64))
    bounds = [(r["lang"], least(r["short"], TRAIN_EACH), least(r["long"], TRAIN_EACH - r["short"]) if r["short"] < TRAIN_EACH else -(1 << 63)) for r in sizes]
    if not bounds:
        return [], np.zeros((0, BUCKETS))
    bounds = docs.sparkSession.createDataFrame(bounds, "lang string, _a long, _b long")
    some = some.join(F.broadcast(bounds) if len(sizes) <= SMALL_IDS else bounds, "lang").where(F.col("_h") <= F.when(F.col("_last"), F.col("_b")).otherwise(F.col("_a")))
    order = Window.partitionBy("lang").orderBy("_last", "_h", "doc_id", "text")
    some = some.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= TRAIN_EACH).select("lang", "text")
    rows = sorted(some.groupBy("lang").applyInPandas(_count, "lang string, counts binary").collect(), key=lambda r: r["lang"])
    if not rows:
        return [], np.zeros((0, BUCKETS))
    counts = 0.05 + np.stack([np.frombuffer(r["counts"], "<i8") for r in rows])
    return [r["lang"] for r in rows], np.log(counts / counts.sum(axis=1, keepdims=True))


def _parse(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b["html"]]
            for lo, hi in slices(np.array([len(t) for t in texts]), 8 << 20):
                said = [declared(t) for t in texts[lo:hi]]
                logs = [text_evidence(model, visible(t)).tolist() for t in texts[lo:hi]]
                yield pa.record_batch([b["page_id"][lo:hi], b["url"][lo:hi], pa.array(said, pa.string()), pa.array(logs, pa.list_(pa.float64()))], names=["page_id", "url", "declared", "logs"])

    return run


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host: a row for each row of pages."""
    names, model = _model(docs)
    n = len(names)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    p = p.mapInArrow(frugal(_parse(model)), "page_id long, url string, declared string, logs array<double>")
    host = F.nullif(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    p = p.withColumn("host", host).withColumn("top", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))
    if not n:
        return p.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    weight = F.transform("logs", F.exp)
    p = cut(p.withColumn("own", F.transform(weight, lambda x: x / F.aggregate(weight, F.lit(0.0), lambda a, y: a + y))))
    vector = lambda of: F.array(*(F.sum(F.col(of)[i]) for i in range(n)))
    whole = p.agg(*(F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(n))).first()
    total = sum(whole) + n
    base = F.array(*(F.lit((x + 1) / total) for x in whole))

    def smoothed(sums, own, prior):
        """Shares of sums without own, with the prior weighing STRENGTH pages."""
        left = F.zip_with(F.zip_with(sums, own, lambda s, o: F.greatest(s - o, F.lit(0.0))), prior, lambda s, q: s + STRENGTH * q)
        return F.transform(left, lambda x: x / F.aggregate(left, F.lit(0.0), lambda a, y: a + y))

    def with_sums(p: DataFrame, key, name: str) -> DataFrame:
        """p with the sums of all its rows that have the same key. Small tables are sent; a larger one is stored, so that
        the join can split a hot key."""
        sums = cut(p.where(key.isNotNull()).groupBy(key.alias("_key")).agg(vector("own").alias(name)))
        sums = F.broadcast(sums) if sums.count() * (8 * n + 64) <= SMALL_BYTES else sums
        return p.join(sums, key == F.col("_key"), "left").drop("_key")

    for key in ("top", "domain", "host"):
        p = with_sums(p, F.col(key), f"sum_{key}")
    p = with_sums(p, F.coalesce("declared", F.lit("-")), "sum_said")
    none = F.array(*(F.lit(0.0) for _ in range(n)))
    p = p.withColumn("q_top", smoothed(F.coalesce("sum_top", none), F.when(F.col("host").isNotNull(), F.col("own")).otherwise(none), base))
    p = p.withColumn("q_domain", smoothed(F.coalesce("sum_domain", none), F.when(F.col("host").isNotNull(), F.col("own")).otherwise(none), F.col("q_top")))
    p = p.withColumn("q_host", smoothed(F.coalesce("sum_host", none), F.when(F.col("host").isNotNull(), F.col("own")).otherwise(none), F.col("q_domain")))
    # a declaration's probability in each language, but for a common factor: its languages' shares by those of all
    p = p.withColumn("q_said", smoothed(F.col("sum_said"), F.col("own"), base))
    score = [F.col("logs")[i] + F.log(F.col("q_host")[i]) + F.log(F.col("q_said")[i] / base[i]) for i in range(n)]
    p = p.withColumn("score", F.array(*score))
    best = F.array_max("score")
    return p.select("page_id", F.get(F.array(*map(F.lit, names)), (F.array_position("score", best) - 1).cast("int")).alias("lang"),
                    (1 / F.aggregate(F.transform("score", lambda x: F.exp(x - best)), F.lit(0.0), lambda a, y: a + y)).alias("probability"),
                    F.when(F.array_max("logs") > F.array_min("logs"), F.get(F.array(*map(F.lit, names)), (F.array_position("logs", F.array_max("logs")) - 1).cast("int"))).alias("text_lang"),
                    "declared", "host")


def op8_language(spark, sf_dir: str) -> DataFrame:
    return identify(load(spark, sf_dir, "pages"), load(spark, sf_dir, "documents"))
