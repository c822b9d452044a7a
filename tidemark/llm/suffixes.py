"""Removal of long repeated byte strings by sorting suffixes, deep-shallow.

A sparse suffix array does: only the suffixes that begin at anchors (see runs.py) are sorted, since every window
of `size` bytes holds its anchor, and of those only the ones that a merged count-min sketch doesn't rule out. Copies of
one context are counted before anything is shuffled and sorted as one key with a number of copies. The contexts of an
anchor are sorted by the suffixes that begin at it and, backwards, by what stands before it: multikey quicksort to a
shallow depth, then blind tries order the groups with long common prefixes. What decides each repeat is the order: a key
with copies has all its windows again, and common prefixes, compared byte by byte, give the windows that stand in
another context too.

A window reaches some bytes beyond its anchor and the rest before it. An anchor with more than GROUP contexts is sorted in
parts. All windows within what its contexts have in common, on both sides, are repeated. The others reach farther on one
side, and are looked for among contexts that have the next bytes on that side too; each such part is smaller, and is parted
again until it can be sorted.

Nulls and texts shorter than `size` bytes have no windows and stay whole. A repeated row is one more occurrence. A text of
any length is handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALL_IDS, cut, fewer, frugal, joined, keyed, lanes, load, rolled
from .runs import Parts, bits_for, discard, packed, per_document, repeated_runs, span_array, span_lists, stored, unpacked

#: Bytes of an anchor (a multiple of eight); bytes that multikey quicksort compares before blind tries take over.
ANCHOR, SHALLOW = 40, 16
#: Contexts that are sorted together at most; those of more frequent anchors are sorted in parts.
GROUP = 1_000


def lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """A trie with the depth of each branching alone: a search looks at branching bytes only, then compares once."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    @staticmethod
    def _byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        if node is None:
            self.root = ([i], None)  # a leaf: the equal strings
            return
        while node[1] is not None:
            node = node[1].get(self._byte(s, node[0])) or next(iter(node[1].values()))
        t = self.strings[node[0][0]]
        if s == t:
            node[0].append(i)
            return
        d, node, parent, at = lcp(s, t), self.root, None, 0
        while node[1] is not None and node[0] < d:
            parent, at = node, self._byte(s, node[0])
            node = node[1][at]
        if node[1] is not None and node[0] == d:
            node[1][self._byte(s, d)] = ([i], None)
            return
        new = (d, {self._byte(t, d): node, self._byte(s, d): ([i], None)})
        if parent is None:
            self.root = new
        else:
            parent[1][at] = new

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[1] is None:
                out += node[0]
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The order of the strings."""
    if len(strings) < 2:
        return list(range(len(strings)))
    base = lcp(min(strings), max(strings))  # all begin alike that far
    out: list[int] = []
    todo = [(list(range(len(strings))), base)]
    while todo:
        part, depth = todo.pop()
        if len(part) < 2:
            out += part
        elif depth >= base + shallow:
            trie = BlindTrie(strings)
            for i in part:
                trie.add(i)
            out += trie.order()
        else:
            byte = {i: strings[i][depth] if depth < len(strings[i]) else -1 for i in part}
            pivot = byte[part[len(part) // 2]]
            same = [i for i in part if byte[i] == pivot]
            todo += [([i for i in part if byte[i] > pivot], depth), (same, depth + 1) if pivot >= 0 else (same, base + shallow), ([i for i in part if byte[i] < pivot], depth)]
    return out


def shared_windows(contexts: list[tuple[bytes, int, int]], size: int) -> list[list[tuple[int, int]]]:
    """contexts: different (bytes, place of the anchor, copies) with one anchor. For each the (first, last) windows, by
    where they begin, that stand in another context or copy too."""
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    right, left = [c[at:] for c, at, _ in contexts], [c[:at][::-1] for c, at, _ in contexts]

    def note(i: int, before: int, after: int) -> None:
        text, at, _ = contexts[i]
        lo, hi = max(size - after, at + size - len(text), 0), min(before, at)
        if lo <= hi:
            found[i].append((at - hi, at - lo))

    order = deep_shallow(right)
    for i in order:
        if contexts[i][2] > 1:
            note(i, len(left[i]), len(right[i]))
    if len(contexts) == 2:
        a, b = lcp(left[0], left[1]), lcp(right[0], right[1])
        note(0, a, b)
        note(1, a, b)
        return found
    rank = {i: r for r, i in enumerate(deep_shallow(left))}
    common = [lcp(right[i], right[j]) for i, j in zip(order, order[1:])]
    # the nodes of the suffix tree: stretches of the order with a common prefix that no wider stretch has
    stack: list[tuple[int, int]] = []  # (depth, begin)
    for k, d in enumerate([*common, -1]):
        begin = k
        while stack and stack[-1][0] > d:
            depth, begin = stack.pop()
            members = sorted(order[begin : k + 1], key=rank.__getitem__)
            near = [lcp(left[i], left[j]) for i, j in zip(members, members[1:])]
            for x, i in enumerate(members):
                note(i, max(near[x - 1] if x else -1, near[x] if x < len(near) else -1), depth)
        if d >= 0 and (not stack or stack[-1][0] < d):
            stack.append((d, begin))
    return found


def byte_parts(texts: list[bytes]) -> Parts:
    """The texts' bytes as symbols."""
    data, ends = joined(texts, b"")
    eight = lanes(data)
    return Parts(data, np.concatenate([[0], ends]), lambda a, b: rolled(eight[a : b - 7], ANCHOR // 8, 8))


def _contexts(size: int):
    """Of documents with lists of contexts: the contexts' bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, sizes = b["at"].flatten(), b["at"].value_lengths().to_numpy(zero_copy_only=False)
            place, out, done = flat.field(3).to_numpy(zero_copy_only=False), [], 0
            for t, m in zip(unpacked(b), sizes.tolist()):
                for x in place[done : done + m].tolist():
                    lo = x >> 32
                    out.append(t[lo : lo + ((x >> 16) & 0xFFFF) + size - 1])
                done += m
            yield pa.record_batch([*(flat.field(i) for i in range(3)), pa.array((place & 0xFFFF).astype(np.int32)), flat.field(4), pa.array(out, pa.binary())],
                                  names=["h", "c1", "c2", "off", "copies", "text"])

    return run


def _sorted_groups(size: int):
    """Of contexts sorted by group g: c1, c2, first, last of the windows that reach lo bytes or more, but not hi, beyond the
    anchor and that another context or copy has too."""
    def emit(group: list[tuple]) -> list[tuple]:
        out = []
        for (c1, c2, off, _, _, lo, hi), spans in zip(group, shared_windows([(g[4], g[2], g[3]) for g in group], size)):
            reach = size - ANCHOR - off  # of window 0
            spans = sorted((max(a, lo - reach), min(b, hi - 1 - reach)) for a, b in set(spans))
            mine: list[tuple[int, int]] = []
            for a, b in spans:
                if mine and a <= mine[-1][1] + 1:
                    mine[-1] = (mine[-1][0], max(b, mine[-1][1]))
                elif a <= b:
                    mine.append((a, b))
            out += [(c1, c2, a, b) for a, b in mine]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at, rows = [], None, []

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["c1", "c2", "j0", "j1"])

        for b in batches:
            for g, h, *rest in zip(*(b[c].to_pylist() for c in ("g", "h", "c1", "c2", "off", "copies", "text", "lo", "hi"))):
                if (g, h) != at:
                    rows += emit(group) if group else []
                    group, at = [], (g, h)
                group.append(tuple(rest))
            yield batch()
            rows.clear()
        rows += emit(group) if group else []
        yield batch()

    return run


def _in_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of groups with their least and largest of what follows the anchor, and of what precedes it as reversed hexadecimal
    digits: how many bytes all of the group have in common, after the anchor and before it."""
    for b in batches:
        rows = list(zip(*(b[c].to_pylist() for c in ("a0", "a1", "b0", "b1"))))
        yield pa.record_batch([b["h"], b["g"], pa.array([lcp(r[0], r[1]) for r in rows], pa.int32()), pa.array([lcp(r[2].encode(), r[3].encode()) // 2 for r in rows], pa.int32())],
                              names=["h", "g", "after", "before"])


def _parted(some: DataFrame, size: int) -> tuple[DataFrame, DataFrame | None]:
    """some: contexts h, c1, c2, off, copies, text. The same with a group g, of GROUP contexts at most, and the reach lo to
    hi of the windows that are looked for in it; and, as c1, c2, j0, j1, windows that all contexts of a larger group have."""
    most = size - ANCHOR  # a window's reach is 0 to most
    now = some.withColumns({"lo": F.lit(0), "hi": F.lit(most + 1), "g": F.lit("")})
    small, same = [], []
    while True:
        many = cut(fewer(now.groupBy("h", "g").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > GROUP).select("h", "g")))
        n = many.count()
        if not n:
            return _all([*small, now]), _all(same)
        send = F.broadcast if n <= SMALL_IDS else lambda df: df
        small.append(now.join(send(many), ["h", "g"], "left_anti"))
        hot = cut(fewer(now.join(send(many), ["h", "g"], "left_semi")))
        after, before = F.col("text").substr(F.col("off") + ANCHOR + 1, F.length("text")), F.reverse(F.hex(F.col("text").substr(F.lit(1), F.col("off"))))
        ends = hot.groupBy("h", "g").agg(F.min(after).alias("a0"), F.max(after).alias("a1"), F.min(before).alias("b0"), F.max(before).alias("b1"))
        ends = cut(fewer(ends.mapInArrow(_in_common, "h long, g string, after int, before int")))
        hot = hot.join(send(ends), ["h", "g"]).drop("g")
        # windows within what all have in common are repeated; the others reach beyond it on one side, where the group parts
        every = F.col("after") + F.col("before") >= most
        shared = hot.where(every).select("c1", "c2", "off", F.greatest("lo", most - F.col("before")).alias("r0"), F.least(F.col("hi") - 1, "after").alias("r1")).where("r0 <= r1")
        same.append(shared.select("c1", "c2", *((F.col(r) - (most - F.col("off"))).cast("int").alias(j) for r, j in (("r0", "j0"), ("r1", "j1")))))
        middle = F.expr(f"cast((after + 1 + {most} - before) div 2 as int)")
        low, high = F.when(every, most - F.col("before")).otherwise(middle), F.when(every, F.col("after") + 1).otherwise(middle)
        sides = F.explode(F.array(F.struct(F.col("lo").alias("lo"), F.least("hi", low).alias("hi")), F.struct(F.greatest("lo", high).alias("lo"), F.col("hi").alias("hi"))))
        split = hot.withColumn("r", sides).drop("lo", "hi", "after", "before").select("*", "r.*").drop("r").where("lo < hi")
        need = most - F.col("hi") + 1  # bytes before the anchor that each of these windows has; after it they have lo
        split = split.where((F.length("text") - F.col("off") - ANCHOR >= F.col("lo")) & (F.col("off") >= need))
        common = F.col("text").substr(F.col("off") - need + 1, need + ANCHOR + F.col("lo"))
        now = cut(fewer(split.withColumn("g", F.concat_ws(":", "lo", "hi", F.sha2(common, 256)))))


def _all(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _repeated(spread: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """c1, c2, j0, j1: the windows j0 to j1 of the runs with that context stand somewhere else too."""
    kinds = spread.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tag", "place", "h")).alias("r")).select("c1", "c2", "copies", "r.*")
    kinds = stored(kinds, few=True)
    anchors = cut(fewer(kinds.groupBy("h").agg(F.sum("copies").alias("m")).where("m > 1").select("h")))  # stored, so that the join can split a hot one
    lists = per_document(kinds.join(anchors, "h"), ["h", "c1", "c2", "place", "copies"])
    one = texts.join(lists, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select("z", "at")  # a repeated row has its contexts once
    found = stored(one.mapInArrow(frugal(_contexts(size)), "h long, c1 long, c2 long, off int, copies long, text binary"), few=True)
    parts, same = _parted(found, size)
    out = parts.repartition("h", "g").sortWithinPartitions("h", "g").select("g", "h", "c1", "c2", "off", "copies", "text", "lo", "hi").mapInArrow(
        frugal(_sorted_groups(size)), "c1 long, c2 long, j0 int, j1 int")
    out = stored(out if same is None else out.unionByName(same), few=True)
    discard(found, kinds)
    return out


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, spans, texts = [], [], []
        for t, (x, y) in zip(unpacked(b), span_lists(b)):
            edges = [0, *np.stack([x, y], 1).ravel().tolist(), len(t)]
            counts.append((len(t), int((y - x).sum())))
            spans.append((x, y))
            texts.append(b"".join(t[i:j] for i, j in zip(edges[::2], edges[1::2])))
        n = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
        yield pa.record_batch([b["id"], b["th"], *n, span_array(spans), pa.array(texts, pa.binary())], names=["doc_id", "th", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """A row for each row of docs: doc_id, th, n_bytes, n_removed, spans (maximal removed start and stop), kept
    binary: without the bytes covered by a `size`-byte string that also starts anywhere else.
    `size` must be over the length of an anchor."""
    if not ANCHOR < size < 1 << 15:
        raise ValueError(f"size must be over {ANCHOR} and under {1 << 15}")
    d = keyed(docs)
    length = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = d.select(F.coalesce("doc_id", "th").alias("doc_id"), F.shiftright("th", 32).cast("int").alias("tag"), "text")
    spread = repeated_runs(rows, byte_parts, size, ANCHOR, bits_for(2 * length // (size - ANCHOR + 2)), few=True)
    texts = packed(d)
    repeated = _repeated(spread, texts, size)
    spans = spread.select("doc_id", "tag", F.shiftright("place", 32).alias("lo"), "c1", "c2").join(repeated, ["c1", "c2"]).select(
        "doc_id", "tag", (F.col("lo") + F.col("j0")).cast("int").alias("start"), (F.col("lo") + F.col("j1") + size).cast("int").alias("stop"))
    return texts.join(per_document(spans, ["start", "stop"]), ["doc_id", "tag"], "left").mapInArrow(
        frugal(_strip), "doc_id long, th long, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary")


def op2_suffixes(spark, sf_dir: str) -> DataFrame:
    out = fewer(remove_repeats(load(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], size: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans and kept_sha256 of each text, from a table of all windows: for tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for p in range(len(t) - size + 1):
            seen[t[p : p + size]] = seen.get(t[p : p + size], 0) + 1
    out = []
    for t in texts:
        gone = set().union(*(range(p, p + size) for p in range(len(t) - size + 1) if seen[t[p : p + size]] > 1))
        spans = [i for i in gone if i - 1 not in gone]
        kept = bytes(c for i, c in enumerate(t) if i not in gone)
        out.append((len(t), len(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


#: Windows as hexadecimal digits, two for a byte.
SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p - 1, 400)) AS k FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 198)) AS p FROM d WHERE length(h) >= 400)),
r AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
m AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM w JOIN r USING (k)),
g AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM m),
s AS (SELECT doc_id, min(p) AS a, max(p) + 199 AS z FROM g GROUP BY doc_id, n),
x AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM s),
t AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last, string_agg(substr(h, 2 * y + 1, 2 * (a - 1 - y)), '' ORDER BY a) AS kept FROM x JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN t.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
