"""Token counts that follow edits without encoding whole documents again.

A document's text is parted where a space stands between two other characters; no pre-token of the tokenizer
crosses such a place, and no added token (they have no white space), so parts can be counted apart. LEAF parts form a leaf; over the leaves stands a segment tree
with sums of tokens and characters, kept with the document as two arrays of its nodes. An edit finds its leaves by
descending the tree along the sums of characters. The touched leaves, with those whose border the edit may change, are
encoded again as one; the rest, their counts and the sums beside the path to the root stay as they are. What apply_edits
returns can be stored and edited again, as often as one likes.

Nulls and empty texts have one empty leaf. Edits are (pos, cut, put) in characters of the text before any edit,
sorted by place; one that begins before the end of an earlier one begins there, and one beyond the text's end
appends. Of edits at one place the shorter cut comes first, then the smaller text. A null list is no edit, a null field is
zero or empty. Repeated rows are separate documents; an empty table gives no rows. A text of any length has one tree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import frugal, keyed, load
from .packing import encoder

#: Parts of a leaf.
LEAF = 24
#: Different parts whose counts a Python worker keeps.
WORDS_KEPT = 150_000
_PART = re.compile(r"(?<=\S)(?= \S)")


class Counter:
    """Tokens of parts; frequent parts are kept."""

    def __init__(self, tokenizer: str):
        self._ids = encoder(tokenizer)
        self._kept: dict[str, int] = {}

    def parts(self, parts: list[str]) -> list[int]:
        kept = self._kept
        new = set(parts).difference(kept)
        if len(kept) + len(new) > WORDS_KEPT:
            kept.clear()
            new = set(parts)
        for p in new:
            kept[p] = len(self._ids(p)) // 4
        return [kept[p] for p in parts]

    def text(self, text: str) -> int:
        return sum(self.parts(_PART.split(text))) if text else 0


def leaves(count: Counter, text: str) -> tuple[list[int], list[int]]:
    """Characters and tokens of each leaf."""
    parts = _PART.split(text)
    n = count.parts(parts) if text else [0]
    chars = [len(p) for p in parts]
    return [sum(chars[i : i + LEAF]) for i in range(0, len(parts), LEAF)], [sum(n[i : i + LEAF]) for i in range(0, len(parts), LEAF)]


class Tree:
    """Sums over leaves: node 1 is the root, node i has the children 2i and 2i + 1; the second half are the leaves."""

    def __init__(self, chars: list[int], tokens: list[int]):
        """Both arrays as they were kept."""
        self.n, self.chars, self.tokens = len(chars) // 2, chars, tokens

    @classmethod
    def over(cls, chars: list[int], tokens: list[int]) -> Tree:
        """The tree over new leaves."""
        n = 1 << max(0, (len(chars) - 1).bit_length())
        tree = cls(*([0] * n + x + [0] * (n - len(x)) for x in (chars, tokens)))
        for i in range(n - 1, 0, -1):
            tree._sum(i)
        return tree

    def _sum(self, i: int) -> None:
        for x in (self.chars, self.tokens):
            x[i] = x[2 * i] + x[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at a place (the last full one at the end), and where it begins."""
        i, begin = 1, 0
        at = min(max(at, 0), max(0, self.chars[1] - 1))
        while i < self.n:
            i *= 2
            if at - begin >= self.chars[i]:
                begin += self.chars[i]
                i += 1
        return i - self.n, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.n
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self._sum(i)


def ordered(edits: list[dict] | None, n: int) -> list[tuple[int, int, str]]:
    """The edits as they apply to a text of n characters: sorted, within the text, not overlapping."""
    out, end = [], 0
    for e in sorted(edits or [], key=lambda e: (e["pos"] or 0, e["cut"] or 0, e["put"] or "")):
        pos = min(max(e["pos"] or 0, end), n)
        stop = max(pos, min((e["pos"] or 0) + max(0, e["cut"] or 0), n))
        out.append((pos, stop, e["put"] or ""))
        end = stop
    return out


def edit(count: Counter, text: str, tree: Tree, edits: list[tuple[int, int, str]]) -> tuple[str, int]:
    """The text after the edits, and the characters encoded again. The tree is updated. Edits go from the last to the
    first, so that places before them stay valid."""
    again = 0
    for pos, stop, put in reversed(edits):
        first, begin = tree.find(pos - 2)
        last, last_begin = tree.find(stop + 1)
        end = last_begin + tree.chars[last + tree.n]
        region = text[begin:pos] + put + text[stop:end]
        text = text[:pos] + put + text[stop:]
        for leaf in range(first + 1, last + 1):
            if tree.chars[leaf + tree.n]:
                tree.set(leaf, 0, 0)
        tree.set(first, len(region), count.text(region))
        again += len(region)
    return text, again


TREE = "tree_chars array<int>, tree_tokens array<int>"


def build(docs: DataFrame, tokenizer: str, keep: list[str] = ()) -> DataFrame:
    """docs' keep columns and text (null: empty) with tree_chars and tree_tokens: the documents' trees, by nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(tokenizer)
        for b in batches:
            trees = [Tree.over(*leaves(count, t.as_py())) for t in b["text"]]
            both = (pa.array([getattr(t, x) for t in trees], pa.list_(pa.int32())) for x in ("chars", "tokens"))
            yield pa.record_batch([*b.columns, *both], names=[*b.schema.names, "tree_chars", "tree_tokens"])

    some = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in some.dtypes)
    return some.mapInArrow(frugal(run), f"{fields}, {TREE}")


def apply_edits(trees: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """trees: what build() or this returned, with a column edits array<struct<pos:int,cut:int,put:string>>. Returns keep with
    text (after the edits), tree_chars, tree_tokens, n_before, n_after, n_again (characters encoded again)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(tokenizer)
        for b in batches:
            rows: list[tuple] = []
            for text, chars, tokens, edits in zip(*(b[c] for c in ("text", "tree_chars", "tree_tokens", "edits"))):
                tree = Tree(chars.as_py(), tokens.as_py())
                t, before = text.as_py(), tree.tokens[1]
                new, again = edit(count, t, tree, ordered(edits.as_py(), len(t)))
                rows.append((new, tree.chars, tree.tokens, before, tree.tokens[1], again))
            types = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([*(b[c] for c in keep), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                                  names=[*keep, "text", "tree_chars", "tree_tokens", "n_before", "n_after", "n_again"])

    fields = "".join(f"`{c}` {t}, " for c, t in trees.select(*keep).dtypes)
    return trees.select(*keep, "text", "tree_chars", "tree_tokens", "edits").mapInArrow(
        frugal(run), f"{fields}text string, {TREE}, n_before long, n_after long, n_again long")


def sample_edits(text):
    """Three edits of each text, set by its length alone: a word put in, characters cut, a piece exchanged."""
    n = F.length(text)
    one = lambda pos, cut, put: F.struct(F.floor(pos).cast("int").alias("pos"), F.lit(cut).alias("cut"), F.lit(put).alias("put"))
    return F.array(one(n / 4, 0, " edited here"), one(n / 2, 12, ""), one(n * 3 / 4, 5, "Zq-9  x"))


def op5_counts(spark, sf_dir: str) -> DataFrame:
    d = keyed(load(spark, sf_dir, "documents")).withColumn("edits", sample_edits(F.col("text")))
    out = apply_edits(build(d, "byte_bpe_50k.json", ["doc_id", "edits"]), "byte_bpe_50k.json", ["doc_id"])
    return out.select("doc_id", "n_before", "n_after", "n_again", F.sha2("text", 256).alias("text_sha256"))
