"""Windows of W symbols, gathered into runs that share an anchor, and a count-min sketch that rules out most of them.

The anchor of a window is its k-symbol piece with the least hash (the first of equal ones). It depends on the
window's symbols alone, so equal windows have equal anchors at equal places, in whichever text they stand.
Consecutive windows with one anchor form a run: one row in place of many. Two equal windows lie in runs with the
same anchor hash; runs whose whole contexts are equal have all windows in common.

Anchors are only counted and brought together by their hashes: that contexts or windows are equal is decided by their
bytes or a cryptographic digest of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import PLAIN_FILES, checkpoint_dir, cut, digests, fewer, frugal, null_safe, sliced

#: Windows that array code looks at together; it bounds memory, and at worst parts a run.
TILE = 1 << 17
#: Most bytes of per-document lists that are sent to every executor; larger ones are joined by a shuffle.
SMALL_BYTES = 8 << 20
#: The sketch: rows, counters that are added up together, and counters of a part, within which all of an anchor's lie.
ROWS, COUNTERS, PART = 2, 1 << 16, 1 << 12
#: The most bits of a row that are sent to every executor: 2 rows of 2**27 are 32 MB. A larger sketch, which has at least
#: two counters for each anchor of any corpus, stays a table, and the runs are joined with its parts.
SENT_BITS = 27
#: Spark's setting that removes an execution's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Anchors of a partition that are counted before they are passed on.
PENDING = 1 << 18


class Parts(NamedTuple):
    """Some texts as symbols: their bytes, where each text's first symbol is (one more than texts), how symbols a to b are
    hashed k at a time, and where the bytes of each symbol begin and end (None: a symbol is a byte)."""

    data: np.ndarray
    first: np.ndarray
    grams: Callable[[int, int], np.ndarray]
    begin: np.ndarray | None = None
    end: np.ndarray | None = None

    def bounds(self, at: np.ndarray, n: np.ndarray) -> tuple[list[int], list[int]]:
        """Where the bytes of the n symbols from `at` begin and end."""
        return (at.tolist(), (at + n).tolist()) if self.begin is None else (self.begin[at].tolist(), self.end[at + n - 1].tolist())


def sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values."""
    have = 1
    while have * 2 <= w:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return np.minimum(key[: len(key) - (w - have)], key[w - have :]) if w > have else key


def runs(grams: Callable[[int, int], np.ndarray], first: np.ndarray, size: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of texts whose symbols are first[i] to first[i + 1]: text number, first window's place, number of windows, the
    anchor's place after it, the anchor's hash."""
    out, total = [], int(first[-1])
    for t in range(0, total - size + 1, TILE):
        u = min(total, t + TILE + size - 1)
        h = grams(t, u)
        least = sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), size - k + 1)
        inside = np.ones(len(least), bool)
        for e in first[np.searchsorted(first, t, "right") : np.searchsorted(first, u, "left")].tolist():
            inside[max(0, e - t - size + 1) : max(0, e - t)] = False
        p = np.flatnonzero(inside)
        if not len(p):
            continue
        a = (least[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)]))
        lo = p[new]
        out.append((np.searchsorted(first, lo + t, "right") - 1, lo + t, np.diff(np.append(new, len(p))), a[new] - lo, h[a[new]]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def stored(df: DataFrame, few: bool = False) -> DataFrame:
    """Write df as a table in the shared folder and read it: smaller than a checkpoint for many rows. What was
    shuffled for it isn't needed again, so its files go when it is written. few: in fewer() files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        (fewer(df) if few else df).write.options(compression="zstd", **PLAIN_FILES, **{"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables. Nothing that still has to run may read them."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def per_document(spans: DataFrame, fields: list[str]) -> DataFrame:
    """doc_id, tag, at array<struct<fields>>: what each document has; never more than its own windows."""
    return spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct(*fields)).alias("at"))


def with_lists(docs: DataFrame, lists: DataFrame, width: int, how: str) -> DataFrame:
    """docs joined with their lists. `width`: bytes of an entry. Lists of at most SMALL_BYTES go to every executor;
    beyond that the documents are shuffled."""
    n, m = lists.agg(F.count(F.lit(1)), F.sum(F.size("at"))).first()
    small = 48 * n + width * (m or 0) <= SMALL_BYTES
    return null_safe(docs, F.broadcast(lists) if small else lists, how)


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, tag (32 bits of th; with doc_id it tells rows apart), z: the text compressed, for a shuffle. id and th
    are the row's own; for a null id doc_id is th, so that rows without an id can be joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for b in batches:
            z = pa.array([squeeze.compress(t.as_py()) for t in b["text"].cast(pa.binary())], pa.binary())
            yield pa.record_batch([b["id"], b["th"], z], names=["id", "th", "z"])

    z = docs.select(F.col("doc_id").alias("id"), "th", "text").mapInArrow(frugal(run), "id long, th long, z binary")
    return z.select(F.coalesce("id", "th").alias("doc_id"), F.shiftright("th", 32).cast("int").alias("tag"), "id", "th", "z")


def unpacked(b: pa.RecordBatch) -> Iterator[bytes]:
    import zstandard

    widen = zstandard.ZstdDecompressor()
    return (widen.decompress(z.as_py()) for z in b["z"])


def spark_hash(h: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of 64-bit numbers, so that the JVM can tell an anchor's places too."""
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    p1, p2, p3, p4 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63))  # fixed values
    x = turn(h * p2, 31) * p1 ^ np.uint64(42 + 0x27D4EB2F165667C5 + 8)
    x = turn(x, 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return x ^ (x >> np.uint64(32))


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The part of the sketch that holds an anchor's counters, and their places in it, one for each row."""
    x, each = spark_hash(h), PART.bit_length() - 1
    return (x >> np.uint64(64 - bits + each)).astype(np.int64), [((x >> np.uint64(each * r)) & np.uint64(PART - 1)).astype(np.int64) for r in range(ROWS)]


def bits_for(anchors: int) -> int:
    """Two to four counters for an anchor."""
    return max(COUNTERS.bit_length() - 1, (2 * anchors).bit_length())


def sketched(docs: DataFrame, anchors: Callable[[pa.Array], Iterator[np.ndarray]], bits: int) -> DataFrame:
    """A merged count-min sketch of the anchors' hashes that `anchors` finds in texts: part, words: a bit for each of the
    part's counters, one row after the other, set where the count is 2 or more. Each partition passes on its counters by
    block; blocks are added up on executors, in two steps where there are many partitions."""
    salts = -(-docs.rdd.getNumPartitions() // 256)  # so many partitions' counters are added up at once
    blocks = COUNTERS // PART

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, pending, n = TaskContext.get().partitionId() % salts, [], 0

        def passed_on() -> pa.RecordBatch:
            part, at = positions(np.concatenate([*pending, np.zeros(0, np.uint64)]), bits)
            order = np.argsort(part, kind="stable")
            block = part[order] // blocks
            begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
            bounds = list(zip(begin.tolist(), [*begin[1:].tolist(), len(block)]))
            rows = [(part % blocks * PART + a)[order].astype(np.uint16) for a in at]
            each = [pa.array([r[a:b].tobytes() for a, b in bounds], pa.binary()) for r in rows]
            return pa.record_batch([pa.array(block[begin]), pa.array(np.full(len(begin), salt, np.int32)), *each], names=["block", "salt", "p0", "p1"])

        for b in batches:
            for h in anchors(b["text"].cast(pa.binary())):
                pending.append(h)
                n += len(h)
                if n >= PENDING:
                    yield passed_on()
                    pending, n = [], 0
        yield passed_on()

    def finished(block: int, total: np.ndarray) -> pd.DataFrame:
        words = np.packbits(total > 1, axis=1, bitorder="little").view("<i8").reshape(ROWS, blocks, PART // 64)
        return pd.DataFrame({"part": block * blocks + np.arange(blocks), "words": list(words.transpose(1, 0, 2).reshape(blocks, -1))})

    def add(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((ROWS, COUNTERS), np.int64)
        for r, c in enumerate(("p0", "p1")):
            for x in p[c]:
                total[r] += np.bincount(np.frombuffer(x, np.uint16), minlength=COUNTERS)
        return finished(key[0], total) if salts == 1 else pd.DataFrame({"block": [key[0]], "counts": [np.minimum(total, 2).astype(np.uint8).tobytes()]})

    def merge(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        return finished(key[0], sum(np.frombuffer(x, np.uint8).astype(np.int64) for x in p["counts"]).reshape(ROWS, COUNTERS))

    parts = docs.select("text").mapInArrow(frugal(count), "block long, salt int, p0 binary, p1 binary")
    if salts == 1:
        return parts.groupBy("block", "salt").applyInPandas(add, "part long, words array<long>")
    return parts.groupBy("block", "salt").applyInPandas(add, "block long, counts binary").groupBy("block").applyInPandas(merge, "part long, words array<long>")


def sent(sketch: DataFrame, bits: int) -> np.ndarray:
    """The sketch as one array of bits, for every executor: at most ROWS * 2**SENT_BITS."""
    out = np.zeros(((1 << bits) // PART, ROWS * PART // 64), np.int64)
    rows = sketch.select("part", "words").toArrow()
    for b in rows.to_batches():
        out[b["part"].to_numpy()] = b["words"].flatten().to_numpy().reshape(b.num_rows, -1)
    return out.view(np.uint64)


def seen_again(h: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors are estimated to occur twice or more; no such anchor is missed."""
    part, at = positions(h, bits)
    often = np.ones(len(h), bool)
    for r, c in enumerate(at):
        often &= (sketch[part, r * (PART // 64) + (c >> 6)] >> (c & 63).astype(np.uint64)) & np.uint64(1) == 1
    return often


def repeated_runs(docs: DataFrame, parts: Callable[[list[bytes]], Parts], size: int, k: int, bits: int, ids: DataFrame | None = None, few: bool = False) -> DataFrame:
    """doc_id, tag, place (first window, windows and the anchor's place in one number), h (the anchor's hash), c1, c2 (the
    context's digest, with the anchor's place in it) of the runs whose anchor is estimated to occur again. Stored.
    docs: doc_id, tag, text; all of them are counted. ids: those whose runs are wanted, if not all. few: see stored()."""
    def each(texts: pa.Array) -> Iterator[tuple]:
        for lo, some in sliced(t.as_py() for t in texts):
            p = parts(some)
            yield lo, p, runs(p.grams, p.first, size, k)

    sketch = sketched(docs, lambda texts: (found[4] for *_, found in each(texts)), bits)
    whole = docs.sparkSession.sparkContext.broadcast(sent(sketch, bits)) if bits <= SENT_BITS else None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, p, found in each(b["text"].cast(pa.binary())):
                if whole is not None:
                    often = seen_again(found[4], whole.value, bits)
                    found = tuple(x[often] for x in found)
                row, at, n, off, h = found
                c = digests(p.data, *p.bounds(at, n + size - 1), off.tolist())
                take = pa.array(row + lo)
                yield pa.record_batch([b["doc_id"].take(take), b["tag"].take(take), pa.array((at - p.first[row] << 32) + (n << 16) + off), pa.array(h.view(np.int64)),
                                       pa.array(c[:, 0]), pa.array(c[:, 1])], names=["doc_id", "tag", "place", "h", "c1", "c2"])

    columns = "doc_id long, tag int, place long, h long, c1 long, c2 long"
    found = (docs if ids is None else ids).select("doc_id", "tag", "text").mapInArrow(frugal(find), columns)
    if whole is not None:
        return stored(found, few)
    each = PART.bit_length() - 1
    x = F.xxhash64("h")
    at = [F.shiftrightunsigned(x, each * r).bitwiseAND(PART - 1).cast("int") for r in range(ROWS)]
    often = [F.getbit(F.get("words", F.lit(r * (PART // 64)) + F.shiftright(a, 6)), a.bitwiseAND(63)) == 1 for r, a in enumerate(at)]
    some = found.withColumn("part", F.shiftrightunsigned(x, 64 - bits + each))
    return stored(some.join(cut(sketch), "part").where(often[0] & often[1]).select(found.columns), few)


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as maximal ones, in order."""
    order = np.argsort(start, kind="stable")
    a, b = start[order], np.maximum.accumulate(stop[order]) if len(stop) else stop
    new = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]])) if len(a) else np.zeros(0, np.int64)
    return a[new], b[np.append(new[1:], len(a)) - 1] if len(a) else b


def span_lists(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The maximal spans of each row's list `at` (null: none)."""
    at = b["at"]
    flat = at.flatten()
    start, stop = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
    sizes = at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    done = 0
    for n in sizes.tolist():
        yield merged(start[done : done + n], stop[done : done + n])
        done += n


def span_array(spans: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """Lists of structs start, stop."""
    ends = np.cumsum([0, *(len(a) for a, _ in spans)]).astype(np.int32)
    both = [np.concatenate([*(s[i] for s in spans), np.zeros(0, np.int64)]).astype(np.int32) for i in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x) for x in both], ["start", "stop"]))
