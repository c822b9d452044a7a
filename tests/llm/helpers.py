"""Small documents for tests."""

import random

DOC = "doc_id long, text string"
#: Extra columns named like the operators' own.
CLASH = "doc_id long, text string, th string, tag string, at string, score string, kept string, id string, n string, component_id string, near string, rest string, spans string"


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randint(0, vocabulary)}" for _ in range(n)]


def frame(spark, rows, clash=True):
    if not clash:
        return spark.createDataFrame(rows, DOC)
    return spark.createDataFrame([(*r, *"abcdefghijk") for r in rows], CLASH)


def empty(spark):
    return spark.createDataFrame([], DOC)


def mixed_documents(seed, n=40):
    """Documents that share passages, with copies, near copies, nulls, empties, odd characters and a repeated row."""
    rnd = random.Random(seed)
    shared = [words(rnd, 60) for _ in range(4)]
    rows = []
    for i in range(n):
        w = words(rnd, rnd.choice([0, 1, 5, 30, 80, 200]))
        for p in rnd.sample(shared, rnd.randint(0, 2)):
            k = rnd.randint(0, len(w))
            a = rnd.randint(0, 20)
            w[k:k] = p[a : a + rnd.randint(10, 60)]
        rows.append((i, " ".join(w) if i % 5 else "\t\n".join(w)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, rows[7][1]), (n + 4, rows[7][1]), (n + 5, "é ü ñ " * 60), (n + 6, "é ü ñ " * 60), (n + 7, "aa " * 300)]
    t = rows[8][1].split() or ["x"]
    rows += [(n + 8 + j, " ".join(t[:k] + ["zz"] + t[k + 1 :])) for j, k in enumerate((0, len(t) // 2))]
    return rows + [rows[3]]
