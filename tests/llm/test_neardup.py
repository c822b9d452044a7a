"""MinHash groups against brute force; components; common counts."""

import random

import numpy as np
import pytest

from tests.llm.helpers import empty, frame, mixed_documents
from tidemark.llm import neardup
from tidemark.llm.components import components


def brute_force(rows, k, share):
    """component of each doc_id, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_group(seed, n=60):
    """Copies of one text with more and more words exchanged, so that chains of links form."""
    rnd = random.Random(seed)
    base = [f"b{rnd.randint(0, 900)}" for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base if i % 3 else rows[rnd.randint(0, i - 1)][1].split() if i else base)
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 40)}"
        rows.append((1000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("k,share", [(3, 85), (5, 80)])
def test_groups(spark, monkeypatch, k, share):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rows = mixed_documents(k) + near_group(k)
    got = neardup.near_duplicates(frame(spark, rows), k, share).collect()
    want = brute_force(rows, k, share)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(w[1] for w in want.values())) < len(want) - 5
    kept = neardup.keep_one(frame(spark, rows), k, share)
    assert {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if w[1] == i} and "component_id" in kept.columns


def test_no_ids_and_no_rows(spark):
    got = neardup.near_duplicates(frame(spark, [(None, "a b c d"), (1, "a b c d"), (2, None)]), 3, 85).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, None, True), (1, 1, True), (2, 2, True)]
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, 500 + i) for i in range(30)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_common_counts():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(0, 40))) for _ in range(9)]
    for columns in (3, 4096):
        got = neardup.common_counts(sets[:4], sets[4:], columns)
        assert got.tolist() == [[float(len(np.intersect1d(a, b))) for b in sets[4:]] for a in sets[:4]]


def test_long_texts(spark):
    """Texts over a slice, and their copies: near duplicates, repeated windows and benchmark words are those of brute force."""
    from tests.llm.test_text_operators import contaminated
    from tidemark.llm import decontam, repeats

    rnd = random.Random(11)
    words = [f"w{rnd.randint(0, 10_000)}" for _ in range(120_000)]
    near = [*words[:60_000], "other", *words[60_001:]]
    rows = [(1, " ".join(words)), (2, "  ".join(near)), (3, " ".join(words[50_000:50_400])), (4, "x" * 700_000), (5, "x" * 700_000), (6, "short one"), (7, " ".join(reversed(words)))]
    assert len(rows[0][1]) > 600_000
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute_force(rows, 3, 85) and got[2][1] == 1 and got[5][1] == 4
    got = {r.doc_id: (r.n_words, r.n_removed) for r in repeats.remove_later_windows(frame(spark, rows), 13).collect()}
    assert got == {i: w[:2] for (i, _), w in zip(rows, repeats.brute_force([(i, t.encode()) for i, t in rows], 13))}
    items = [(1, " ".join(words[-12:])), (2, "other " + " ".join(words[60_001:60_008])), (3, "nowhere at all")]
    found = {r.doc_id: tuple(r["items"] or ()) for r in decontam.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {i: hit for i, _, _, hit in contaminated([(i, t) for i, t in rows if i not in (1, 2, 7)], items, 10)} | {1: ("1",), 2: ("1", "2"), 7: ()}


def test_results_beyond_the_bounds_of_broadcasts(spark, monkeypatch):
    """With every bound at nothing, the same steps shuffle and give the same."""
    from tests.llm.test_text_operators import pages
    from tidemark.llm import common, language, runs, suffixes, surrogates

    rows = mixed_documents(9, 20) + near_group(3, 12) + [(5000 + i, f"mail a{i % 3}.b@c.com or 192.168.0.{i}") for i in range(6)]
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(suffixes, "GROUP", 3)
    monkeypatch.setattr(surrogates, "DENSE", 1 << 14)  # so that a range is dense
    docs, web, _ = pages()

    def results():
        d = frame(spark, rows)
        return [sorted(map(str, df.collect())) for df in (
            neardup.keep_one(d, 3, 85), suffixes.remove_repeats(d, 60), surrogates.replace_private(d, b"k"),
            language.identify(spark.createDataFrame(web[:20], "page_id long, url string, html string"), spark.createDataFrame(docs, "doc_id long, text string, lang string")).selectExpr("page_id", "lang", "round(probability, 9) as p"))]
    want = results()
    for module in (common, neardup, suffixes, surrogates, language):
        monkeypatch.setattr(module, "SMALL_IDS", 0)
    for module in (runs, language):
        monkeypatch.setattr(module, "SMALL_BYTES", 0)
    assert results() == want
