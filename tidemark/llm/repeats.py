"""Removal of word windows that a document with a smaller doc_id has, behind a count-min prefilter.

First pass: each partition counts the anchors (see runs.py) of its windows in a count-min sketch; the sketches are
merged. A window's anchor occurs at least as often as the window, so the merged counts never fall short of a
window's count. Second pass: only runs of windows estimated to be repeated leave the executors, and are grouped
exactly, by a cryptographic digest of their words: runs with equal contexts share the smallest doc_id; where one anchor
has several contexts, their windows are grouped one by one. Whatever the sketch lets through by mistake is found unique
there, so no result depends on its size.

Nulls and texts under `size` words have no windows. Rows without a doc_id come before and after no document: they
take nothing and give nothing. Repeated rows have one doc_id, so they don't remove each other. A text of any length is
handled whole; words of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, digests, frugal, joined, keyed, load, rolled, sliced, word_bounds, word_hashes
from .runs import Parts, bits_for, discard, packed, per_document, repeated_runs, span_array, span_lists, stored, unpacked

ANCHOR = 6


def word_parts(texts: list[bytes]) -> Parts:
    """The texts' words as symbols; one space parts them, so equal sequences have equal bytes."""
    data, ends = joined([b" ".join(t.split()) for t in texts])
    start, stop, first = word_bounds(data, ends)
    h = word_hashes(data, start, stop)
    return Parts(data, first, lambda a, b: rolled(h[a:b], ANCHOR), start, stop)


def _windows(size: int):
    """Of documents with lists of runs: each window's digest, its context and its place in the run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, texts in sliced(unpacked(b)):
                p, lists = word_parts(texts), b["at"][lo : lo + len(texts)]
                flat, row = lists.flatten(), np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
                c1, c2, place = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                least = b["doc_id"][lo : lo + len(texts)].to_numpy(zero_copy_only=False)[row]
                at, n = place >> 32, (place >> 16) & 0xFFFF
                each = np.repeat(np.arange(len(at)), n)
                j = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                w = digests(p.data, *p.bounds(p.first[row[each]] + at[each] + j, np.int64(size)), [0] * len(each))
                yield pa.record_batch([pa.array(w[:, 0]), pa.array(w[:, 1]), pa.array(c1[each]), pa.array(c2[each]), pa.array(j.astype(np.int32)), pa.array(least[each])],
                                      names=["w1", "w2", "c1", "c2", "j", "least"])

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, spans, kept = [], [], []
        for t, (x, y) in zip(unpacked(b), span_lists(b)):
            words = t.split()
            left = np.ones(len(words), bool)
            for i, j in zip(x.tolist(), y.tolist()):
                left[i:j] = False
            counts.append((len(words), len(words) - int(left.sum())))
            spans.append((x, y))
            kept.append(b" ".join(compress(words, left.tolist())))
        n = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
        yield pa.record_batch([b["id"], b["th"], *n, span_array(spans), pa.array(kept, pa.binary())], names=["doc_id", "th", "n_words", "n_removed", "spans", "kept"])


def remove_later_windows(docs: DataFrame, size: int = 13) -> DataFrame:
    """A row for each row of docs: doc_id, th, n_words, n_removed, spans (removed words as start and stop), kept
    binary: the kept words joined by a space. `size` must be over the words of an anchor."""
    if not ANCHOR < size < 1 << 15:
        raise ValueError(f"size must be over {ANCHOR} and under {1 << 15}")
    d = keyed(docs)
    length = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = d.select("doc_id", F.shiftright("th", 32).cast("int").alias("tag"), "text")
    found = repeated_runs(rows, word_parts, size, ANCHOR, bits_for(length // 24), rows.where("doc_id is not null"))
    kinds = stored(found.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "tag", "place", "h")).alias("r"), F.max("doc_id").alias("last")).select("c1", "c2", "r.*", "last"))
    anchors = cut(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"))  # stored, so that the join can split a hot one
    mixed = kinds.join(anchors, "h").select("doc_id", "tag", "c1", "c2", "place")
    texts = packed(d)
    windows = stored(texts.join(per_document(mixed, ["c1", "c2", "place"]), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select("doc_id", "z", "at").mapInArrow(
        frugal(_windows(size)), "w1 long, w2 long, c1 long, c2 long, j int, least long"))
    earlier = windows.groupBy("w1", "w2").agg(F.min("least").alias("first"), F.max("least").alias("end")).where("first < end").select("w1", "w2", "first")
    # a window that an earlier document has in another context; those of the context's own documents come with `whole`
    each = stored(windows.join(earlier, ["w1", "w2"]).where("first < least").select("c1", "c2", F.col("j").alias("j0"), F.col("j").alias("j1"), F.col("first").alias("least")))
    discard(windows)
    n = F.shiftright("place", 16).bitwiseAND(0xFFFF)
    whole = kinds.where("last > doc_id").select("c1", "c2", F.lit(0).alias("j0"), (n - 1).cast("int").alias("j1"), F.col("doc_id").alias("least"))
    spans = found.select("doc_id", "tag", F.shiftright("place", 32).alias("lo"), "c1", "c2").join(whole.unionAll(each), ["c1", "c2"]).where("least < doc_id").select(
        "doc_id", "tag", (F.col("lo") + F.col("j0")).cast("int").alias("start"), (F.col("lo") + F.col("j1") + size).cast("int").alias("stop"))
    return texts.join(per_document(spans, ["start", "stop"]), ["doc_id", "tag"], "left").mapInArrow(
        frugal(_strip), "doc_id long, th long, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary")


def op6_repeats(spark, sf_dir: str) -> DataFrame:
    out = remove_later_windows(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int, bytes]], size: int) -> list[tuple[int, int, str]]:
    """n_words, n_removed and kept_sha256 of each document: for tests."""
    first: dict[tuple, int] = {}
    for i, t in docs:
        w = t.split()
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = t.split()
        gone = set().union(*(range(p, p + size) for p in range(len(w) - size + 1) if first[tuple(w[p : p + size])] < i))
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return out


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
n AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 12), ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS least FROM n GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM n JOIN f USING (k) WHERE least < doc_id),
x AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""
