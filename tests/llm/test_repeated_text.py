"""Suffix and window removal against brute force; count-min sketches; anchors."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import empty, frame, mixed_documents
from tidemark.llm import common, neardup, repeats, runs, suffixes


def rows_of(df, *columns):
    return Counter(tuple(r[c] if c != "kept" else bytes(r[c]) for c in columns) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes(spark, seed):
    rows = [*mixed_documents(seed), (None, "q" * 450), (None, None)]
    got = suffixes.remove_repeats(frame(spark, rows), 60).collect()
    want = suffixes.brute_force([(t or "").encode() for _, t in rows], 60)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), sha(r.kept)) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert sum(r.n_removed for r in got) > 0
    assert suffixes.remove_repeats(empty(spark), 60).count() == 0


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_suffixes_of_200_bytes(spark):
    rnd = random.Random(12)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    long = noise(700_000)  # over a slice
    passage, line = noise(450), noise(150)
    rows = [(i, noise(rnd.randint(0, 300)) + passage[rnd.randint(0, 200) : rnd.randint(210, 450)] + noise(rnd.randint(0, 90)) + line + noise(40)) for i in range(40)]
    rows += [(100, long[:300_000] + passage + long[300_000:]), (101, long[600_000:]), (102, "x" * 2000), (103, "y" * 199), (104, passage[:200]), (None, passage), (105, None), (106, "é" * 250)]
    rows += [rows[3]]
    want = suffixes.brute_force([(t or "").encode() for _, t in rows], 200)
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), sha(r.kept)) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))


@pytest.mark.parametrize("most", [2, 3])
def test_suffixes_of_a_frequent_anchor(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "GROUP", most)  # so that an anchor's contexts are sorted in parts
    rnd = random.Random(4)
    line = "".join(rnd.choice("abcdef") for _ in range(90))
    rows = [(i, "".join(rnd.choice("ghij") for _ in range(rnd.randint(0, 80))) + line[: rnd.choice([55, 70, 90])] + "".join(rnd.choice("gh") for _ in range(60))) for i in range(14)]
    rows += [(20 + i, "gg" + line[20:] + "ghghg" * i) for i in range(6)]
    got = {r.doc_id: (r.n_removed, sha(r.kept)) for r in suffixes.remove_repeats(frame(spark, rows), 60).collect()}
    assert got == {i: (w[1], w[3]) for (i, _), w in zip(rows, suffixes.brute_force([t.encode() for _, t in rows], 60))}


def test_deep_shallow_order():
    rnd = random.Random(6)
    for n in (0, 1, 2, 50):
        strings = [b"common" + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [b"commonaaa"] * 3
        for shallow in (0, 2, 30):
            assert [strings[i] for i in suffixes.deep_shallow(strings, shallow)] == sorted(strings)


def test_shared_windows():
    rnd = random.Random(8)
    for _ in range(60):
        size, core = 12, bytes(rnd.choice(b"xy") for _ in range(5))
        contexts = [(*c, 1) for c in sorted({(bytes(rnd.choice(b"ab") for _ in range(a)) + core + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(7, 9))), a) for a in (rnd.randint(0, 7) for _ in range(rnd.randint(2, 9)))})]
        contexts[0] = (*contexts[0][:2], rnd.randint(1, 2))
        found = suffixes.shared_windows(contexts, size)
        for i, (text, at, copies) in enumerate(contexts):
            def windows(c):
                return {(j - c[1], c[0][j : j + size]) for j in range(len(c[0]) - size + 1) if j <= c[1] and j + size >= c[1] + 5}
            others = set().union(*(windows(c) for k, c in enumerate(contexts) if k != i or copies > 1))
            want = {j + at for j, w in windows((text, at)) if (j, w) in others}
            got = {j for a, b in found[i] for j in range(a, b + 1) if j <= at and j + size >= at + 5}
            assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    rows = [*mixed_documents(seed), (-5, "earlier " * 20), (90, "earlier " * 20)]
    got = repeats.remove_later_windows(frame(spark, rows), 13).collect()
    want = repeats.brute_force([(i, (t or "").encode()) for i, t in rows], 13)
    assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))
    alone = repeats.remove_later_windows(frame(spark, [(None, "a b c d e f g h i j k l m n"), (3, "a b c d e f g h i j k l m n")]), 13).collect()
    assert {r.n_removed for r in alone} == {0}
    assert repeats.remove_later_windows(empty(spark), 13).count() == 0


def removed(spark, operator, rows):
    return rows_of(operator(frame(spark, rows), 13 if operator is repeats.remove_later_windows else 60), "doc_id", "n_removed", "kept")


@pytest.mark.parametrize("operator", [repeats.remove_later_windows, suffixes.remove_repeats])
def test_results_do_not_depend_on_the_sketch(spark, monkeypatch, operator):
    rows = mixed_documents(3)
    a = removed(spark, operator, rows)
    monkeypatch.setattr(runs, "SENT_BITS", 10)  # the sketch stays a table
    assert removed(spark, operator, rows) == a
    monkeypatch.undo()
    monkeypatch.setattr(runs, "seen_again", lambda h, sketch, bits: np.ones(len(h), bool))  # a sketch that lets all through
    assert removed(spark, operator, rows) == a


def test_sketch_never_falls_short(spark, monkeypatch):
    monkeypatch.setattr(runs, "PENDING", 700)
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 3000, 6000).astype(np.uint64)
    docs = spark.createDataFrame([(" ".join(map(str, values[i : i + 50].tolist())),) for i in range(0, 6000, 50)], "text string")
    twice = np.array([v for v, n in Counter(values.tolist()).items() if n > 1], np.uint64)
    for parts in (5, 300):  # added up in one step, and in two
        sketch = runs.sent(runs.sketched(docs.repartition(parts), lambda texts: (np.array(t.as_py().split(), dtype=np.uint64) for t in texts), 16), 16)
        assert runs.seen_again(twice, sketch, 16).all()
        assert runs.seen_again(np.arange(10_000, 20_000, dtype=np.uint64), sketch, 16).mean() < 0.1


def test_places_are_those_of_spark(spark):
    h = np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    got = spark.createDataFrame([(i, int(x)) for i, x in enumerate(h.view(np.int64))], "i int, h long").selectExpr("i", "xxhash64(h) as x").orderBy("i").collect()
    assert [r.x for r in got] == runs.spark_hash(h).view(np.int64).tolist()


def thue_morse(n):
    """Two texts of 2**n words over two letters, each the other's complement: sums of powers of any odd base agree."""
    bits = [bin(i).count("1") & 1 for i in range(1 << n)]
    return " ".join("ab"[x] for x in bits), " ".join("ba"[x] for x in bits)


@pytest.mark.parametrize("n", [10, 12])
def test_words_that_a_sum_of_powers_confuses(spark, n):
    a, b = (t.replace(" ", "") for t in thue_morse(n))
    tail = " one two three four five six seven eight nine ten eleven twelve"
    assert len(a) == 1 << n and a != b
    got = repeats.remove_later_windows(frame(spark, [(1, a + tail), (2, b + tail)]), 13).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0}
    got = neardup.near_duplicates(frame(spark, [(1, f"{a} x y"), (2, f"{b} x y")]), 3, 85).collect()
    assert {r.component_id for r in got} == {1, 2}
    x, y = thue_morse(n)
    got = repeats.remove_later_windows(frame(spark, [(1, x), (2, y)]), 1000).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: w[1] for i, w in zip((1, 2), repeats.brute_force([(1, x.encode()), (2, y.encode())], 1000))}


def test_word_hashes():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.choice([1, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(3000)})
    data, ends = common.joined([" ".join(words).encode(), b"", b" \t", words[0].encode()])
    start, stop, first = common.word_bounds(data, ends)
    h = common.word_hashes(data, start, stop)
    assert first.tolist() == [0, len(words), len(words), len(words), len(words) + 1] and len(set(h.tolist())) == len(words) and h[-1] == h[0]
    h = h[:-1]
    for k, unit in ((1, 1), (5, 1), (6, 1), (13, 1), (5, 8)):
        r, n = common.rolled(h, k, unit), len(h) - unit * (k - 1)
        assert len(r) == n and len(set(r.tolist())) == n
        assert common.rolled(h[7:], k, unit)[3] == r[10]


def test_merged_spans():
    rnd = random.Random(5)
    for _ in range(50):
        spans = [(a, a + rnd.randint(1, 6)) for a in (rnd.randint(0, 40) for _ in range(rnd.randint(0, 8)))]
        a, b = runs.merged(np.array([x for x, _ in spans], np.int64), np.array([y for _, y in spans], np.int64))
        want = sorted({i for x, y in spans for i in range(x, y)})
        assert [i for x, y in zip(a, b) for i in range(x, y)] == want and all(y < x for y, x in zip(b, a[1:]))


def test_runs_cover_each_window_once(monkeypatch):
    rnd = np.random.default_rng(2)
    monkeypatch.setattr(runs, "TILE", 37)  # so that texts are parted
    lengths = [0, 5, 20, 21, 200, 19]
    x = rnd.integers(0, 4, sum(lengths)).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    row, at, n, off, h = runs.runs(lambda a, b: common.rolled(x[a:b], 6), first, 20, 6)
    seen = Counter((int(r), int(a + j - first[r])) for r, a, m in zip(row, at, n) for j in range(m))
    assert seen == Counter((r, p) for r, length in enumerate(lengths) for p in range(length - 19))
    by_window = {}
    for r, a, m, o, hh in zip(row, at, n, off, h):
        for j in range(m):  # equal windows have the anchor at the same place
            assert by_window.setdefault(x[a + j : a + j + 20].tobytes(), (int(o - j), int(hh))) == (int(o - j), int(hh))


def test_steps_write_few_files(spark, tmp_path):
    """Tables of many partitions are written in two files for each core, and neither they nor checkpoints with checksum files."""
    import glob
    import os

    from tidemark.llm import common, runs

    folder = spark.conf.get("spark.checkpoint.dir")
    files = lambda: {f for f in glob.glob(f"{folder}/**/*", recursive=True) + glob.glob(f"{folder}/**/.*", recursive=True) if os.path.isfile(f)}
    before, df = files(), spark.range(0, 500, 1, 50)
    table = runs.stored(df, few=True)
    assert table.count() == 500 and 1 <= len(files() - before) <= 2 * spark.sparkContext.defaultParallelism
    assert common.cut(df).count() == 500 and not [f for f in files() - before if f.endswith(".crc")]
    assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.file.impl.disable.cache") is None  # as it was
    runs.discard(table)
