"""What the operators of this subpackage share: inputs, storage between steps, and byte-level array code.

Conventions for every operator here
-----------------------------------
* Only the named input columns are read, so extra columns (also ones named like an output) never clash.
* A missing or null text is an empty text; an empty table gives an empty result with the same columns.
* Rows are identified by ``(doc_id, xxhash64(text))``: repeated rows each get their own (equal) result row,
  and rows with a null doc_id are ordinary rows unless an operator says otherwise.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Most (doc_id, hash) pairs that are sent to every executor, 16 bytes each; with more, the documents are shuffled.
SMALL_IDS = 1_000_000
#: Bytes of text that array code handles at once; it bounds the memory of a Python worker, not what is read.
SLICE_BYTES = 512 << 10
#: Spark's setting of the rows of an Arrow batch, its default, and what prepare() puts in its place.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000")
#: Hadoop's settings for steps' files in a folder of the scheme file. Hadoop starts a chmod for each file, three with a
#: checksum file beside it, and while a JVM starts a process, its memory counts twice.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: Bytes of a word from which on it is hashed by xxh3 instead of eight bytes at a time.
LONG_WORD = 64


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from spark.checkpoint.dir; a local one only where that is unset and Spark is local."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        return set_to
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), "checkpoints")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Store df in the shared folder and go on from there: lost executors don't bring back the work before it."""
    checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    before = {k: conf.get(k) for k in PLAIN_FILES}
    for k, v in PLAIN_FILES.items():
        conf.set(k, v)
    try:
        return df.checkpoint(eager=True)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def fewer(df: DataFrame) -> DataFrame:
    """df in at most two tasks for each core, which go through several partitions one after another: so many files are
    written, and not one for each small partition (see PLAIN_FILES)."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def prepare(spark: SparkSession) -> SparkSession:
    """The session with smaller Arrow batches, unless it has a size of its own: rows here are whole texts, and batches of
    10,000 of them take much memory in the JVM and in each Python worker. The registered queries and stages do this."""
    if spark.conf.get(BATCH_ROWS[0]) == BATCH_ROWS[1]:
        spark.conf.set(BATCH_ROWS[0], BATCH_ROWS[2])
    return spark


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """run, a function for mapInArrow, giving memory back to the system when it ends: Spark keeps Python workers for later
    steps, and what their allocators keep would add up."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return of


def release() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id long, text (null: empty), th: the text's hash, which tells apart different rows of one doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("th", F.xxhash64("text"))


def sampled(rows: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """The `most` rows with the least hash of key. total: about how many rows there are; so only some more than `most` rows
    of all partitions are sorted, not `most` of each."""
    h = F.xxhash64(key)
    if total > 2 * most:
        rows = rows.where(h < int(-(1 << 63) + 2 * most / total * (1 << 64)))
    return rows.orderBy(h, key).limit(most)


def null_safe(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, th), where a null doc_id equals a null doc_id. right's copies of the keys are dropped."""
    r = right.withColumnsRenamed({"doc_id": "_doc_id", "th": "_th"})
    on = left["doc_id"].eqNullSafe(r["_doc_id"]) & (left["th"] == r["_th"])
    return left.join(r, on, how).drop("_doc_id", "_th")


def without(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that have no (doc_id, th) in marked."""
    gone = cut(marked.select(F.col("doc_id").alias("_d_"), F.col("th").alias("_t_")).distinct())
    th = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    small = F.broadcast(gone) if gone.count() <= SMALL_IDS else gone
    return docs.join(small, F.col("doc_id").eqNullSafe(F.col("_d_")) & (th == F.col("_t_")), "left_anti")


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Consecutive row ranges of at most `most` bytes; a longer row stands alone, whole."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and total + n > most:
            out.append((begin, i))
            begin, total = i, 0
        total += n
    if len(sizes) > begin:
        out.append((begin, len(sizes)))
    return out


def sliced(texts: Iterable[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of at most `most` bytes together, and the number of the first; a longer one stands alone, whole."""
    lo, some, total = 0, [], 0
    for t in texts:
        if some and total + len(t) > most:
            yield lo, some
            lo, some, total = lo + len(some), [], 0
        some.append(t)
        total += len(t)
    if some:
        yield lo, some


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mask(n: np.ndarray) -> np.ndarray:
    """The low min(n, 8) bytes of a 64-bit number."""
    return _MASKS[np.minimum(n, 8)]


_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as a little-endian number. A view: nothing is copied."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, 0, (1,))


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of 64-bit values. Each step scrambles, so no arithmetic between symbols cancels out."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def rolled(h: np.ndarray, k: int, unit: int = 1) -> np.ndarray:
    """The hash of each k values that stand `unit` places apart: pairs are folded, then pairs of pairs, and so on."""
    out, done, width = None, 0, unit
    while True:
        if k & 1:
            if out is None:
                out = h
            else:
                n = max(0, min(len(out), len(h) - done))
                out = fold(out[:n], h[done : done + n])
            done += width
        k >>= 1
        if not k:
            return out
        h = fold(h[: max(0, len(h) - width)], h[width:])
        width *= 2


#: The white space that parts words in the contracts on words, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_bounds(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of concatenated texts, each followed by a white-space byte; ends: the place after that byte.
    Start and stop of each word, and how many words lie before each text (one more entry than texts)."""
    gap = SPACE[data[: int(ends[-1]) if len(ends) else 0]]
    edge = np.diff(gap.astype(np.int8), prepend=np.int8(1))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(stop) and stop[0] == 0:
        stop = stop[1:]
    return start, stop, np.concatenate([[0], np.searchsorted(start, ends)])


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time; data has eight bytes or more after the last word."""
    at, n = lanes(data), stop - start
    h = mix64(n.astype(np.uint64), 100)
    short = np.flatnonzero((n > 0) & (n <= LONG_WORD))
    done = 0
    while len(short):
        h[short] = mix64(h[short] ^ (at[start[short] + done] & _mask(n[short] - done)), 101)
        done += 8
        short = short[n[short] > done]
    if len(long := np.flatnonzero(n > LONG_WORD)):
        import xxhash

        view = memoryview(data)
        h[long] = [xxhash.xxh3_64_intdigest(view[a:b], 17) for a, b in zip(start[long].tolist(), stop[long].tolist())]
    return h


def digests(data: memoryview | bytes, starts: list[int], stops: list[int], marks: list[int]) -> np.ndarray:
    """Two 64-bit halves of a cryptographic digest of each stretch of bytes with its mark: what decides that stretches are
    equal. Two different ones among 10**12 have one digest with a chance under 10**-14."""
    from hashlib import blake2b

    view = memoryview(data)
    out = b"".join(blake2b(view[a:b], digest_size=16, salt=m.to_bytes(4, "little")).digest() for a, b, m in zip(starts, stops, marks))
    return np.frombuffer(out, "<i8").reshape(-1, 2)


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, each followed by gap, and eight zero bytes; where each ends, its gap included."""
    data = np.frombuffer(gap.join([*texts, b""]) + bytes(8), np.uint8)
    return data, np.cumsum([len(t) + len(gap) for t in texts], dtype=np.int64)
