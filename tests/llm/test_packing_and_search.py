"""Packing, nearest neighbours, the pipeline, and the queries with SQL."""

import glob
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.helpers import same
from tests.llm.helpers import empty, frame, mixed_documents
from tests.llm.test_neardup import brute_force, near_group
from tests.llm.test_text_operators import contaminated, labelled
from tidemark.llm import neighbours, packing, queries, suffixes, tokencounts, toxicity


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(rows, got, tokenizer, most=1024):
    """The pieces are those of the rows' ids, and lie in sequences without gap or overlap."""
    want = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % most + 1
        for k, s in enumerate([0, *range(first, len(ids), most)]):
            n = first if k == 0 else most
            want.append((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == order(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= most
    return len(bins)


def test_packing(spark, tokenizer):
    rnd = random.Random(5)
    texts = ["a  b", " lead", "trail ", "x\n y", "\n", "  q", "it's we'll 12 3.4", "tab\t tab", "", None, "word " * 3000, "\x1c \x1c z", "<|startoftext|> hi"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, " ".join(rnd.choice(["alpha", "beta's", "gamma\ndelta", "12,000", "é"]) for _ in range(rnd.randint(0, 900)))) for i in range(60)] + [(3, "x\n y"), (None, "null id")]
    got = packing.pack_documents(frame(spark, rows)).collect()
    n = check_packing(rows, got, tokenizer)
    assert n <= -(-sum(r.length for r in got) // 1024) + 1
    assert packing.pack_documents(empty(spark)).count() == 0


def marked_texts(seed=3, n=150):
    """Texts with the vocabulary's added token in many places, and parts of it."""
    rnd = random.Random(seed)
    some = ["<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "end", "start.", "é", "'s", "12", "<|", "\t"]
    return ["end <|endoftext|> start", "<|endoftext|>", "<|endoftext|><|endoftext|> a", " <|endoftext|>  b"] + ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_packing_of_added_tokens(spark, tokenizer):
    rows = list(enumerate(marked_texts()))
    assert tokenizer.encode(rows[0][1], add_special_tokens=False).ids == [437, 220, 50256, 923]
    check_packing(rows, packing.pack_documents(frame(spark, rows)).collect(), tokenizer)


def test_a_text_is_encoded_in_one_call(tokenizer, monkeypatch):
    """Words that were never seen cost no call each; that took most of the time of packing."""
    import tiktoken

    calls = Counter()
    for name in ("encode_ordinary", "encode_to_numpy"):
        def counted(self, *a, _name=name, _real=getattr(tiktoken.Encoding, name), **k):
            calls[_name] += 1
            return _real(self, *a, **k)

        monkeypatch.setattr(tiktoken.Encoding, name, counted)
    ids = packing.encoder("byte_bpe_50k.json")
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("aeinrstßé'1.-\n") for _ in range(rnd.randint(1, 12)))
    for text in [" ".join(word() for _ in range(n)) for n in (1, 3, 50, 2000)] + ["a  b \t c\u3000\u2003 d \x1c " * 400]:
        calls.clear()
        assert np.frombuffer(ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert calls.total() == 1, calls


def test_a_million_characters_of_white_space(spark, tokenizer):
    many, long = 1_000_100, 100_000
    texts = ["a" + " " * many + "b", "\n" * many, "x " + " \n" * (many // 2) + "<|endoftext|> y", " " * many + "\u3000" * long + "\x1c" + "\t" * long + "'s",
             "a" + " " * long + "b" + "\n" * (long + 1) + "c" + " " * (long - 1) + "d" + "\x1d" * long]
    rows = list(enumerate(texts))
    check_packing(rows, packing.pack_documents(frame(spark, rows)).collect(), tokenizer)
    count = tokencounts.Counter("byte_bpe_50k.json")
    assert [count.text(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_added_tokens(tokenizer):
    rnd = random.Random(4)
    count = tokencounts.Counter("byte_bpe_50k.json")
    want = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for text in marked_texts(5) + [" ".join(marked_texts(6))]:
        tree = tokencounts.Tree.over(*tokencounts.leaves(count, text))
        assert tree.tokens[1] == want(text), text
        edits = [{"pos": rnd.randint(0, len(text)), "cut": rnd.choice([0, 1, 4, 13]), "put": rnd.choice(["", " ", "<|endoftext|>", "|>", "x"])} for _ in range(3)]
        new, _ = tokencounts.edit(count, text, tree, tokencounts.ordered(edits, len(text)))
        assert tree.tokens[1] == want(new), (text, edits)


def test_local_search():
    rnd = random.Random(1)
    for most, sizes in ((100, [rnd.randint(1, 100) for _ in range(300)]), (10, [6, 6, 4, 4, 5, 5, 3, 7]), (100, [34] * 30 + [33] * 30 + [51] * 5)):
        start = packing.best_fit(sizes, most)
        # a poor start: one item in each bin
        alone = packing.LocalSearch(sizes, [[i] for i in range(len(sizes))], most).run()
        for bins in (packing.pack(sizes, most), alone):
            assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= most for b in bins)
        assert len(packing.pack(sizes, most)) <= len(start) and len(alone) <= len(start) + 3


def test_bounds_of_the_search_cost_nothing(monkeypatch):
    rnd = random.Random(2)
    some = [[min(1024, int(rnd.lognormvariate(5.6, 1))) or 1 for _ in range(600)], [rnd.randint(300, 520) for _ in range(500)], [rnd.choice([200, 341, 342, 513, 700]) for _ in range(500)]]
    bound = [len(packing.pack(sizes, 1024)) for sizes in some]
    for name in ("PLACES", "SECONDS", "ROUNDS", "STEPS"):
        monkeypatch.setattr(packing, name, 1 << 20)
    assert bound == [len(packing.pack(sizes, 1024)) for sizes in some]


def test_exchange_empties_a_bin():
    # best fit can't do it: 6+3 | 5+4 | 2 with room 10 needs 6+4 | 5+3+2
    assert len(packing.LocalSearch([6, 3, 5, 4, 2], [[0, 1], [2, 3], [4]], 10).run()) == 2


# ---- nearest neighbours

def exact(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return {q: [i for _, i in sorted((-float((v * x).sum()), i) for i, v in ok if i != q and len(v) == len(x))[:k]] for q, x in ok if q % 20 == 0 and any(len(v) == len(x) and i != q for i, v in ok)}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(out[r.query_id])
    return out


def test_neighbours_are_exact_in_one_part(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "MOST_PARTS", 1)
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(120)]  # one very common vector
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [1.0, None] * 4), (2080, [float("nan")] * 8), (2100, [float("inf")] * 8), (2120, [1.0] * 3), (2140, [2.0] * 3), (2141, [-1.0, 0.5, 0.0]), (2160, [4.0] * 5), (None, [1.0] * 8)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    rows = [(i, np.array(v, np.float32).tolist() if v and None not in v else v) for i, v in rows]
    assert found(neighbours.nearest(d, lambda i: i % 20 == 0)) == exact(rows, 20)
    few = spark.createDataFrame([(0, [1.0] * 8), (1, [2.0] * 8)], "vec_id long, embedding array<float>")
    assert found(neighbours.nearest(few, lambda i: i % 20 == 0)) == {0: [1]}
    assert neighbours.nearest(few.limit(0), lambda i: i % 20 == 0).count() == 0


def test_neighbours_of_repeated_rows(spark):
    """Rows with one vec_id count as one, by their best score; equal vectors tie by vec_id."""
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (7, [0.5, 0.0]), (7, [0.9, 0.2]), (7, [0.9, 0.2]), (5, [0.9, 0.2]), (3, [0.8, 0.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, round(r.score, 6)) for r in got] == [(0, 5, 0.9), (0, 7, 0.9), (0, 3, 0.8), (20, 5, 0.2), (20, 7, 0.2), (20, 0, 0.0)]


def recall(got, want):
    return np.mean([len(set(got[q]) & set(w)) / len(w) for q, w in want.items()])


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 300)
    monkeypatch.setattr(neighbours, "QUERIES", 40)
    rnd = np.random.default_rng(4)
    centers = rnd.normal(size=(30, 8)) * 3
    x = (centers[rnd.integers(0, 30, 3000)] + rnd.normal(size=(3000, 8))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i % 20 == 0)), exact(rows, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_neighbours_of_the_table(spark):
    """Every query of the table, whose vectors have hardly any clusters, against all rows."""
    got = neighbours.op9_neighbours(spark, "/root/testdata/sf0.1")
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want, got = exact(rows, 20), found(got)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values()) and recall(got, want) >= 0.9


def test_parts_are_few_of_clustered_vectors():
    rnd = np.random.default_rng(8)
    centers = rnd.normal(size=(64, 16)) * 2
    x = centers[rnd.integers(0, 64, 4000)] + rnd.normal(size=(4000, 16)) * 0.5
    router, probes = neighbours.learn(x, 64, 12, 0.94)
    assert probes <= 16


def test_balanced_parts():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(800, 6))
    links = neighbours.graph(x, 8)
    part = neighbours.balanced(x, links, 8)
    assert np.bincount(part, minlength=8).max() <= 127
    assert (part[links] == part[:, None]).mean() > 2 / 8


# ---- pipeline

def test_pipeline(spark, tmp_path, tokenizer):
    import corpus_pipeline

    rows, labels = labelled(400)
    rows += [(10_000 + i, t) for i, t in mixed_documents(5)[:-1]] + near_group(6, 20) + [(20_000, "mail bob.7@mail.example.com today"), (20_001, "mail bob.7@mail.example.com soon")]
    items = [(1, " ".join((rows[405][1] or "").split()[:15])), (2, "unrelated words of an item that no document has anywhere at all")]
    d = str(tmp_path / "sf")
    full = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    full.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.dtypes == full.dtypes
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        steps[name] = {r.doc_id: r.text for r in docs.collect()}
    by = dict(rows)
    marks = {r.doc_id: r.score for r in toxicity.score(full, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    left = {i for i, s in marks.items() if s < 0.5}
    assert set(steps["toxicity"]) == left and len(left) < len(rows) - 80
    groups = brute_force([(i, by[i]) for i in left], 5, 80)
    left = {i for i, g in groups.items() if g[1] == i}
    assert set(steps["near_duplicates"]) == left
    hits = {i for i, _, n, _ in contaminated([(i, by[i]) for i in left], items, 10) if n}
    assert set(steps["decontamination"]) == left - hits and hits
    private = steps["private_data"]
    assert set(private) == left - hits and "bob.7" not in private[20_000] and private[20_000].split()[1] == private[20_001].split()[1]
    assert all(private[i] == (by[i] or "") for i in private if i < 20_000)
    check_packing(list(private.items()), corpus_pipeline.run(spark, d).collect(), tokenizer)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Each stage and the whole with nulls in any column, repeated rows, a long text, other columns, and empty tables."""
    import corpus_pipeline

    columns = "doc_id long, text string, lang string, source string, n_chars long, th string, score string, kept string, at string, component_id string"
    long = " ".join(f"w{i % 9973}" for i in range(150_000))
    rows = [(None, "no id here", None, None, None), (1, None, "en", "s", None), (2, "", None, "s", 0), (3, "twice the same", "en", None, 14), (3, "twice the same", "en", None, 14), (4, long, "en", "s", len(long)),
            (5, "mail a.b@c.com from No. 5", "en", "s", 20), (6, long, "de", "s", len(long))]
    tables = {"documents": (rows, columns), "labels": ([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int"), "benchmark": ([(1, None), (None, "x"), (2, "")], "item_id long, text string")}
    for empty_one in (None, *tables, "all"):
        d = f"{tmp_path}/{empty_one}"
        for t, (r, schema) in tables.items():
            r = [] if empty_one in (t, "all") else [(*x, *"abcde") for x in r] if t == "documents" else r
            spark.createDataFrame(r, schema).write.parquet(f"{d}/{t}.parquet")
        docs = spark.read.parquet(f"{d}/documents.parquet")
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, d)
            assert got.columns == corpus_pipeline.COLUMNS, name
            docs = spark.createDataFrame(got.collect(), got.schema)
            assert docs.count() == (n if name == "toxicity" else max(0, n - 1)), name  # the long text stands there twice
        want = docs.count()
        out = corpus_pipeline.run(spark, d)
        assert out.select("doc_id").distinct().count() == max(0, want - 1) and (want == 0) == out.isEmpty()


@pytest.mark.parametrize("name,columns", {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int", "op2_suffixes": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean", "op4_decontam": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_counts": "doc_id bigint, n_before bigint, n_after bigint, n_again bigint, text_sha256 string", "op6_repeats": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op7_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint", "op8_language": "page_id bigint, lang string, probability double",
    "op10_surrogates": "doc_id bigint, n_entities bigint, kinds string, text string"}.items())
def test_query(spark, name, columns):
    """Every query gives a row for each row of its table, or piece, with the columns and types that its contract has."""
    got = queries.queries()[name](spark, "/root/testdata/sf0.001")
    types = dict(got.dtypes)
    assert {c.split()[0]: c.split()[1] for c in columns.split(", ")}.items() <= types.items()
    table = "pages" if name == "op8_language" else "documents"
    ids = Counter(r[0] for r in spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").select("page_id" if table == "pages" else "doc_id").collect())
    rows = got.collect()
    assert Counter(r[0] for r in rows if name != "op7_packing" or r.piece == 0) == ids
    if name == "op1_toxicity":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)


def test_surrogates_query_against_brute_force(spark):
    """op10 on a whole table: what is found is replaced, one for one in the whole corpus, by what is found as the same kind;
    the rest stays."""
    from tidemark.llm import surrogates

    d = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    new: dict[tuple, str] = {}
    for r in surrogates.op10_surrogates(spark, "/root/testdata/sf0.01").collect():
        text, done, at = d[r.doc_id], 0, 0
        spans = surrogates.detect(text)
        found = surrogates.detect(r.text)
        assert r.n_entities == len(spans) == len(found) and r.kinds == ",".join(sorted({k.split("/")[0] for *_, k in spans}))
        for (a, b, kind), (x, y, again) in zip(spans, found):
            assert text[done:a] == r.text[at:x] and kind == again
            key = kind, surrogates.canonical(kind, text[a:b])
            assert new.setdefault(key, r.text[x:y].lower()) == r.text[x:y].lower() != text[a:b].lower()
            done, at = b, y
        assert text[done:] == r.text[at:]
    assert len(set(new.values())) == len(new) > 50 and not {v for _, v in new} & set(new.values())


def test_suffixes_query_against_brute_force(spark):
    """op2 on a whole table of 1,000 documents, byte by byte."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = suffixes.brute_force([(r.text or "").encode() for r in d], 200)
    got = suffixes.op2_suffixes(spark, "/root/testdata/sf0.01").collect()
    assert Counter(tuple(r) for r in got) == Counter((r.doc_id, *w) for r, w in zip(d, want)) and sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for f in glob.glob("/root/testdata/sf0.001/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    same(queries.queries()[name](spark, "/root/testdata/sf0.001").toPandas(), c.execute(queries.oracle_sql()[name]).df())
