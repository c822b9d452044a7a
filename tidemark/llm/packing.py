"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

Documents are tokenized, end with an end token, and only longer ones are cut. Pieces are dealt at random over
groups of bounded size; each group is packed alone: first best-fit decreasing, then a local search that takes
the underfull sequences, emptiest first, and moves a document, or exchanges one for one or two for one, with
other underfull sequences. A step is taken only if it raises the sum of squared fills, which empties sequences.

Pieces of one length are interchangeable; which goes where follows the hash of their text, then doc_id and number.
Nulls and empty texts are documents of the end token alone. A repeated row is a document of its own. An empty
table gives no rows. A text of any length is cut into pieces; it never has to fit a sequence.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, frugal, keyed, load

#: Pieces that one task packs, about. More only saves the last, underfull sequence of a group.
GROUP_PIECES = 20_000
#: Characters of a text from which on an array is quicker to get than a list. Both hold the same ids.
SHORT_TEXT = 64
#: Characters of white space in a row that are encoded apart: tiktoken's regular expression fails on a million of them.
LONG_SPACE = 100_000
#: How far the local search looks: places of one size that it tries, second documents of a pair, rounds over the bins, and
#: steps from one bin for each of its documents. They bound its time; a step that it doesn't see may cost a sequence, none
#: in the tests' instances. Pieces are never dropped.
PLACES, SECONDS, ROUNDS, STEPS = 8, 8, 8, 12


#: White space as the tokenizer's pattern has it, which is not Python's.
_SPACE = r"[^\S\x1c-\x1f]"
_LONG_SPACE = re.compile(f"(?<!{_SPACE}){_SPACE}{{{LONG_SPACE},}}")


class FastIds:
    """The ids of a byte-level BPE as little-endian unsigned 32-bit bytes.

    Texts are encoded whole, straight into an array: where many words are new, to split them off and keep their ids takes
    longer. Added tokens (text without white space to id) are looked for first; what is between them is encoded apart.
    White space in a row is one pre-token; where text follows, its last character is not part of it.
    """

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # told of added tokens, though it never sees one: without any, it searches for the empty string at each place
        self._own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        self._added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        # of two that begin at one place, the longer
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def __call__(self, text: str) -> bytes:
        if self._marks and self._marks.search(text):
            return b"".join(self._added[t] if i % 2 else self(t) for i, t in enumerate(self._marks.split(text)))
        if len(text) >= LONG_SPACE and (runs := [m.span() for m in _LONG_SPACE.finditer(text)]):
            out, at = [], 0
            for a, b in runs:
                b -= b < len(text)
                out += [self(text[at:a]), np.array(self._own._encode_single_piece(text[a:b]), "<u4").tobytes()]
                at = b
            return b"".join([*out, self(text[at:])])
        if len(text) < SHORT_TEXT:
            return np.array(self._own.encode_ordinary(text), "<u4").tobytes()
        return self._own.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def encoder(tokenizer: str) -> FastIds:
    """For a vocabulary file of the installed tokenizers package; its ranks file lies beside it."""
    import public_tokenizers

    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if odd := [a["content"] for a in added if a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"])]:
        raise ValueError(f"added tokens with white space or rules of their own: {odd}")
    return FastIds(public_tokenizers.path(tokenizer.replace(".json", ".tiktoken")), public_tokenizers.PATTERN, {a["content"]: a["id"] for a in added})


def cut_points(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: of `most` tokens each, but the first may be shorter."""
    first = (n - 1) % most + 1
    return [(0, first), *((s, most) for s in range(first, n, most))]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, most: int) -> DataFrame:
    """doc_id, th, piece, start, length, ids_crc32 of each piece of each document."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for b in batches:
            rows: list[list] = [[] for _ in range(6)]
            for doc, th, text in zip(b["doc_id"].to_pylist(), b["th"].to_pylist(), b["text"]):
                ids = ids_of(text.as_py()) + end
                for k, (s, n) in enumerate(cut_points(len(ids) // 4, most)):
                    for to, v in zip(rows, (doc, th, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]))):
                        to.append(v)
            yield pa.record_batch([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                  names=["doc_id", "th", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "th", "text").mapInArrow(frugal(pieces), "doc_id long, th long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], most: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of item numbers."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(most + 1)]
    has = 0  # bit r: some bin has room r
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[i]
        if fits := has >> n:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                has &= ~(1 << r)
        else:
            r, b = most, len(bins)
            bins.append([])
        bins[b].append(i)
        if r - n:
            room[r - n].append(b)
            has |= 1 << (r - n)
    return bins


class LocalSearch:
    """Moves and swaps between underfull bins. Each step raises the sum of squared fills, so it ends."""

    def __init__(self, sizes: list[int], bins: list[list[int]], most: int):
        self.sizes, self.most = sizes, most
        self.bins = bins
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.stamp = [0] * len(bins)
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (bin, stamp)
        self.place: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # most that can replace an item -> (bin, stamp, item)
        self.has_room = self.has_place = 0
        self.open = [b for b in range(len(bins)) if self.fill[b] < most]
        for b in self.open:
            self._enter(b)

    def _enter(self, b: int) -> None:
        r = self.most - self.fill[b]
        if not r or not self.bins[b]:
            return
        self.room[r].append((b, self.stamp[b]))
        self.has_room |= 1 << r
        for i in self.bins[b]:
            self.place[v := r + self.sizes[i]].append((b, self.stamp[b], i))
            self.has_place |= 1 << v

    def _find(self, table: dict, bits: str, least: int, fits) -> tuple | None:
        """The entry at the smallest value from `least` on that is current and fits."""
        rest = getattr(self, bits) >> least
        while rest:
            v = least + (rest & -rest).bit_length() - 1
            entries = table[v]
            while entries and entries[-1][1] != self.stamp[entries[-1][0]]:
                entries.pop()
            if not entries:
                setattr(self, bits, getattr(self, bits) & ~(1 << v))
            for e in entries[-PLACES:]:
                if e[1] == self.stamp[e[0]] and fits(e):
                    return e
            rest &= rest - 1
        return None

    def _change(self, a: int, b: int, out: list[int], back: int | None) -> None:
        """`out` goes from bin a to bin b, `back` the other way."""
        for x, gone, new in ((a, out, [back] if back is not None else []), (b, [back] if back is not None else [], out)):
            self.bins[x] = [i for i in self.bins[x] if i not in gone] + new
            self.fill[x] = sum(self.sizes[i] for i in self.bins[x])
            self.stamp[x] += 1
            self._enter(x)

    def _better(self, a: int, b: int, gain: int) -> bool:
        """Whether b's gain, taken from a, raises the sum of squared fills."""
        return a != b and gain > 0 and self.fill[b] + gain > self.fill[a]

    def _step(self, a: int) -> bool:
        own = sorted(self.bins[a], key=lambda i: -self.sizes[i])
        for i in own:
            n = self.sizes[i]
            if e := self._find(self.room, "has_room", n, lambda e: self._better(a, e[0], n)):
                self._change(a, e[0], [i], None)
                return True
        pairs = [[i] for i in own] + [[i, j] for k, i in enumerate(own) for j in own[k + 1 : k + 1 + SECONDS]]
        for out in pairs:
            n = sum(self.sizes[i] for i in out)
            if n <= self.most and (e := self._find(self.place, "has_place", n, lambda e: self._better(a, e[0], n - self.sizes[e[2]]))):
                self._change(a, e[0], out, e[2])
                return True
        return False

    def run(self) -> list[list[int]]:
        """Rounds over the underfull bins, emptiest first, until one changes nothing."""
        for _ in range(ROUNDS):
            changed = False
            for a in sorted((b for b in self.open if self.bins[b] and self.fill[b] < self.most), key=lambda b: self.fill[b]):
                for _ in range(STEPS * len(self.bins[a])):
                    if not self.bins[a] or self.fill[a] == self.most or not self._step(a):
                        break
                    changed = True
            if not changed:
                break
        return [b for b in self.bins if b]


def pack(sizes: list[int], most: int) -> list[list[int]]:
    return LocalSearch(sizes, best_fit(sizes, most), most).run()


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, most: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece of each row of docs.
    sequence_id is the group's number times 2**32 and a number within the group."""
    if most < 1:
        raise ValueError("a sequence holds at least one token")
    pieces = cut(tokenize(keyed(docs), tokenizer, end_id, most))
    groups = max(1, round(pieces.count() / GROUP_PIECES))

    def place(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["length", "th", "doc_id", "piece"], kind="stable", ignore_index=True)
        seq, off = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        sizes = p["length"].tolist()
        for k, b in enumerate(pack(sizes, most)):
            at = 0
            for i in b:
                seq[i], off[i] = (int(key[0]) << 32) + k, at
                at += sizes[i]
        return p.assign(sequence_id=seq, offset=off)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64("th", "doc_id", "piece"), F.lit(groups)))
    return dealt.groupBy("_g").applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"))
