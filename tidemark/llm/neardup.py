"""Near-duplicate documents by MinHash.

1. Each text becomes its set of word shingles, a signature of universal hash minima and band keys.
2. Texts with equal sets are one class, represented by its smallest doc_id, so copies never meet as pairs.
3. In each band bucket every class is paired with the bucket's smallest one; pairs whose signatures agree well
   enough are confirmed on full sets, and links become components by large-star and small-star steps.
4. All classes that were paired with one smallest class, its members, may still be in several components. Those outside
   the most frequent one are compared with all, in blocks of bounded size that are dealt over all tasks, first by
   signature, which leaves few members, then on full sets. No pairs leave a block, only links that join components. The
   components of all links are the result.

After step 4 each two classes that share a bucket are in one component or were compared, so no link is lost but
those that banding misses: there are as many bands as keep that under MISS, once in 100,000 times at the least similarity.

Shingles are 64-bit hashes of their words. Two different ones of a pair of sets of 10,000 meet with a chance of
10**8 / 2**64, 5 in 10**12, and that shifts a similarity by one shingle; classes have equal 128-bit hashes of all.

Nulls: a null or wordless text has no shingles and links with nothing. Rows without a doc_id take no part; their
component is null and they are kept. Repeated rows share a class. Texts of any length are hashed whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALL_IDS, cut, frugal, joined, keyed, load, mix64, rolled, sliced, without, word_bounds, word_hashes
from .components import components

#: Minima of a band, and how often all bands may miss a pair at the least similarity.
ROWS, MISS = 5, 1e-5
#: Members of a block, about.
BLOCK = 128
#: Pairs whose signatures agree this much less than asked are still confirmed on full sets: over four standard errors.
SLACK = 0.16


def bands_for(share: int) -> int:
    """The least number of bands that miss a pair with this similarity (in hundredths) at most MISS of the time."""
    same = (share / 100) ** ROWS
    return 1 if same >= 1 else math.ceil(math.log(MISS) / math.log1p(-same))


@lru_cache
def _universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles (64-bit hashes, sorted) of each text, one after another, and their counts.
    A text of fewer words has its whole sequence as the only one."""
    data, ends = joined([t.lower() for t in texts])
    start, stop, first = word_bounds(data, ends)
    w = word_hashes(data, start, stop)
    shingles = mix64(rolled(w, k)) if len(w) >= k else np.zeros(0, np.uint64)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(shingles[a : b - k + 1]))
        elif b > a:
            sets.append(mix64(rolled(w[a:b], b - a), b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array([len(s) for s in sets], np.int64)


def signatures(values: np.ndarray, counts: np.ndarray, minima: int) -> np.ndarray:
    """The least of each universal hash over each set; a row for each set that isn't empty."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(starts), minima), np.uint32)
    if len(starts):
        for k, (a, b) in enumerate(zip(*_universal(minima))):
            out[:, k] = np.minimum.reduceat((values * a + b) >> np.uint64(32), starts)
    return out


def _sketch(k: int, n_bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            texts = b["text"].cast(pa.binary())
            for lo, some in sliced(t.as_py() for t in texts):
                hi = lo + len(some)
                values, counts = shingle_sets(some, k)
                sig, full = signatures(values, counts, n_bands * ROWS), counts > 0
                bands = np.zeros((len(sig), n_bands), np.uint64)
                for j in range(n_bands):
                    for r in range(ROWS):
                        bands[:, j] = mix64(bands[:, j] * np.uint64(31) + sig[:, j * ROWS + r], j)
                at = np.concatenate([[0], np.cumsum(counts)])
                dig = [xxhash.xxh3_128_digest(values[at[i] : at[i + 1]].tobytes()) for i in range(hi - lo)]
                two = np.frombuffer(b"".join(dig), "<i8").reshape(-1, 2) if dig else np.zeros((0, 2), np.int64)
                row = np.cumsum(full) - 1
                yield pa.record_batch([
                    b["doc_id"][lo:hi], b["th"][lo:hi], pa.array(counts), pa.array(two[:, 0]), pa.array(two[:, 1]),
                    pa.array([sig[row[i]].tobytes() if full[i] else None for i in range(hi - lo)], pa.binary()),
                    pa.array([bands[row[i]].view(np.int64) if full[i] else None for i in range(hi - lo)], pa.list_(pa.int64())),
                ], names=["doc_id", "th", "n", "h1", "h2", "sig", "bands"])

    return run


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id, shingles array<long> of the documents in ids (a column id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary())
            for lo, some in sliced(t.as_py() for t in texts):
                hi = lo + len(some)
                values, counts = shingle_sets(some, k)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.record_batch([b["id"][lo:hi], pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))], names=["id", "shingles"])

    small = ids.count() <= SMALL_IDS
    need = docs.withColumnRenamed("doc_id", "id").join(F.broadcast(ids) if small else ids, ["id", "th"], "left_semi")
    return need.select("id", "text").mapInArrow(frugal(run), "id long, shingles array<long>").dropDuplicates(["id"])


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, share: int) -> DataFrame:
    """Of pairs (u, v): those whose sets reach the similarity share / 100, first by signature, then on full sets."""
    sig = classes.select("id", "th", "n", "sig")
    both = pairs.join(sig.select(F.col("id").alias("u"), F.col("th").alias("tu"), F.col("n").alias("nu"), F.col("sig").alias("su")), "u").join(
        sig.select(F.col("id").alias("v"), F.col("th").alias("tv"), F.col("n").alias("nv"), F.col("sig").alias("sv")), "v")
    both = both.where(100 * F.least("nu", "nv") >= share * F.greatest("nu", "nv"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("su", "sv"))
            near = pa.array((x == y).mean(axis=1) >= share / 100 - SLACK) if b.num_rows else pa.array([], pa.bool_())
            yield b.select(["u", "v", "tu", "tv", "nu", "nv"]).filter(near)

    near = cut(both.select("u", "v", "tu", "tv", "nu", "nv", "su", "sv").mapInArrow(agree, "u long, v long, tu long, tv long, nu long, nv long"))
    ids = near.select(F.col("u").alias("id"), F.col("tu").alias("th")).unionAll(near.select(F.col("v").alias("id"), F.col("tv").alias("th"))).distinct()
    sets = cut(_sets(docs, ids, k))  # used twice, and so that the joins can split a hot center
    left = near.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
    full = left.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    return full.where(100 * common >= share * (F.col("nu") + F.col("nv") - common)).select("u", "v")


def _sent(centers: DataFrame) -> DataFrame:
    """A row for each of some centers, stored and, if they are few, sent to every executor; so a join with it leaves no
    center to one task."""
    centers = cut(centers)
    return F.broadcast(centers) if centers.count() <= SMALL_IDS // 4 else centers


def _in_blocks(members: DataFrame) -> DataFrame:
    """members (center, id, c, ...) of each center, dealt so that each of its members outside its most frequent component
    meets all others in one group (center, x, y), on side 0 the former: by blocks of about BLOCK on either side."""
    shape = members.groupBy("center", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("center").agg(F.max(F.struct("n", "c")).alias("most"), F.sum("n").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    shape = shape.select("center", F.col("most.c").alias("main"), blocks(F.col("all") - F.col("most.n")).alias("nx"), blocks(F.col("all")).alias("ny"))
    rows = members.join(_sent(shape), "center")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("c <> main").withColumns({"x": deal("nx"), "side": F.lit(0)}).withColumn("y", each("ny"))
    right = rows.withColumns({"y": deal("ny"), "side": F.lit(1)}).withColumn("x", each("nx"))
    # without this all blocks of a center would stay in the task that the joins by center put them into
    return left.drop("main", "nx", "ny").unionByName(right.drop("main", "nx", "ny")).repartition("center", "x", "y")


def _sides(p: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    return p[p.side == 0], p[p.side == 1]


def _open_members(pairs: DataFrame, labels: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """center, id, c, n: members whose signature agrees with that of a member of another component."""
    some = pairs.select(F.col("u").alias("center"), F.col("v").alias("id")).join(labels.withColumnsRenamed({"u": "id", "v": "c"}), "id", "left")
    some = some.withColumn("c", F.coalesce("c", "id"))
    mixed = some.groupBy("center").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("center")
    rows = some.join(_sent(mixed), "center").join(classes.select("id", "n", "sig"), "id")
    # a byte of each minimum is enough here: equal minima agree, and others once in 256 times
    rows = _in_blocks(cut(rows.select("center", "id", "c", "n", F.unhex(F.regexp_replace(F.hex("sig"), "(..)......", "$1")).alias("low"))))
    least = share / 100 - SLACK

    def find(p: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(p)
        if not len(left) or not len(right):
            return p.iloc[:0][["center", "id", "c", "n"]]
        sig = [np.frombuffer(b"".join(s.low), np.uint8).reshape(len(s), -1) for s in (left, right)]
        comp, size = ([s[c].to_numpy() for s in (left, right)] for c in ("c", "n"))
        ok = (comp[0][:, None] != comp[1]) & (100 * np.minimum(size[0][:, None], size[1]) >= share * np.maximum(size[0][:, None], size[1]))
        i, j = np.nonzero(ok)
        near = np.concatenate([np.zeros(0, bool), *((sig[0][i[a : a + 8192]] == sig[1][j[a : a + 8192]]).mean(axis=1) >= least for a in range(0, len(i), 8192))])
        return pd.concat([left.iloc[np.unique(i[near])], right.iloc[np.unique(j[near])]])[["center", "id", "c", "n"]].drop_duplicates()

    return rows.groupBy("center", "x", "y").applyInPandas(find, "center long, id long, c long, n long").distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many values each set on the left shares with each on the right. Values of one set alone don't count."""
    sets = [*left, *right]
    values, which, count = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    new = np.cumsum(count > 1) - 1
    keep = count[which] > 1
    row, col = row[keep], new[which[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(new[-1]) + 1 if len(new) else 0, columns):
        lo, hi = np.searchsorted(col, [a, a + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[row[lo:hi], col[lo:hi] - a] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _links_between(members: DataFrame, docs: DataFrame, classes: DataFrame, k: int, share: int) -> DataFrame:
    """u, v: links, on full sets, that join the components of members which share a center."""
    ids = members.select("id").distinct().join(classes.select("id", "th"), "id")
    rows = _in_blocks(cut(members.join(_sets(docs, ids, k), "id")))

    def join(p: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(p)
        if not len(left) or not len(right):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        common = common_counts(list(left.shingles), list(right.shingles))
        comp, size, ids = ([s[c].to_numpy() for s in (left, right)] for c in ("c", "n", "id"))
        near = 100 * common >= share * (size[0][:, None] + size[1][None] - common)
        root = {int(c): int(c) for s in comp for c in s}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        found = []
        for i, j in zip(*np.nonzero(near & (comp[0][:, None] != comp[1][None]))):
            a, b = find(int(comp[0][i])), find(int(comp[1][j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((int(ids[0][i]), int(ids[1][j])))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return rows.groupBy("center", "x", "y").applyInPandas(join, "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """A row for each row of docs: doc_id, th, n_shingles, component_id (null without a doc_id), kept.
    k: words in a shingle; share: least similarity in hundredths."""
    d = keyed(docs)
    sketched = cut(d.mapInArrow(frugal(_sketch(k, bands_for(share))), "doc_id long, th long, n long, h1 long, h2 long, sig binary, bands array<long>"))
    live = sketched.where("n > 0 and doc_id is not null")
    classes = cut(live.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "n", "sig", "bands")).alias("s")).select(
        "h1", "h2", F.col("s.doc_id").alias("id"), "s.th", "s.n", "s.sig", "s.bands"))
    buckets = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pairs = buckets.join(shared.select("key", "least"), "key").where("id <> least").select(F.col("least").alias("u"), F.col("id").alias("v"))
    pairs = cut(pairs.distinct())
    links = cut(_confirm(pairs, classes, d, k, share))
    first = components(links)
    members = cut(_open_members(pairs, first, classes, share))
    if not members.isEmpty():
        links = links.unionAll(cut(_links_between(members, d, classes, k, share)))
        first = components(links)
    labels = classes.select("h1", "h2", "id").join(first.withColumnsRenamed({"u": "id", "v": "c"}), "id", "left")
    labels = labels.select("h1", "h2", F.coalesce("c", "id").alias("component"))
    out = sketched.select("doc_id", "th", "n", "h1", "h2").join(labels, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """The rows of docs without those that have a near duplicate with a smaller doc_id; all columns stay."""
    return without(docs, near_duplicates(docs, k, share).where("not kept"))


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), 3, 85).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT u, v FROM p UNION SELECT v, u FROM p),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.v FROM r JOIN l ON r.y = l.u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM s JOIN (SELECT x AS doc_id, min(y) AS c FROM r GROUP BY x) USING (doc_id)
"""
