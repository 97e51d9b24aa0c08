"""Packing token sequences into windows by minimum bin slack.

A document longer than a window fills whole windows; what remains of each is one item, and only the lengths of the
items matter to the packing. Their histogram (at most one row a length) goes to the driver, where a bitset subset-sum
finds, for the longest item left, the multiset of lengths that comes closest to the capacity, and backtracking gives
the counts. The same multiset is used as often as the histogram allows, so the plan has some thousand rows for any
number of documents. Where no multiset fills a window, one item is cut to fill it and its tail goes back to the
histogram. Each item finds its sequence by its rank among the items of its length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmine.lineage import scratch_scope
from sparkmine.llm.common import kept, slices

CAPACITY, END = 2048, 1
#: bytes of text tokenised at a time, words remembered between them (some two hundred bytes each)
SLICE, CACHE = 1 << 20, 600_000

#: blanks that the split of a text must leave to the tokenizer, as not everyone takes them for blanks
ODD_BLANK = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
PLAIN_BLANK = re.compile("[ \t\n\r\f\v]+")
#: words of these characters are composed already and have one lower case, so that they need no look at their neighbours
SIMPLE = re.compile(r"[\x21-\x7e\xa1-\xac\xae-\u012f\u0131-\u0148\u014a-\u017e]+")
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Ids(dict):
    """Ids of blank-separated words as bytes, made by the tokenizer's own merges when a word is first seen."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        for probe in ("It's 12 O'Clock!? don't,", "Ünïcödé ÀÉ ½x²", "a<|b", "x" * 300):
            if self.encode(probe).tobytes() != self.library(probe):
                raise ValueError("this tokenizer splits texts in a way that is not supported")

    def library(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if SIMPLE.fullmatch(word) is None:
            found = self.library(word)
        else:
            low = word.lower()
            parts = [low] if low.isalpha() else PARTS.findall(low)
            if len(parts) == 1 and parts[0] == word:
                text = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
                found = array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()
            else:
                found = b"".join([self[p] for p in parts])
        self[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if any([s in text for s in self.special]):
            return np.frombuffer(self.library(text), dtype=self.dtype)
        words = text.split() if ODD_BLANK.search(text) is None else PLAIN_BLANK.split(text)
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=self.dtype)

    def shrink(self) -> None:
        if len(self) > CACHE:
            self.clear()


@lru_cache(maxsize=1)
def word_ids(path: str) -> Ids:
    return Ids(path)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def items(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Whole windows and the rest of every document: ``doc_id, doc_tokens, full, windows, run, length, place, rest``.

    ``full`` are the checksums of the whole windows and ``windows`` how many the ``run`` (a task) had before them; ``place``
    counts the rests of one length inside the run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task = word_ids(path), TaskContext.get().partitionId()
        seen, windows = [0] * capacity, 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                model.shrink()
                rows = []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ids = model.encode(text or "")
                    if k == 0 and ids.tobytes() != model.library(text or ""):
                        raise AssertionError("the words and the library differ")
                    ids = np.append(ids, np.array([end], dtype=ids.dtype))
                    whole = len(ids) // capacity
                    rest = ids[whole * capacity:]
                    full = [checksum(ids[i * capacity:(i + 1) * capacity]) for i in range(whole)]
                    rows.append((len(ids), full, windows, len(rest), seen[len(rest)], rest.tobytes()))
                    seen[len(rest)] += 1
                    windows += whole
                n, full, ahead, length, place, rest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(ahead, pa.int64()), pa.array(np.full(len(rows), task)),
                     pa.array(length, pa.int32()), pa.array(place, pa.int64()), pa.array(rest, pa.binary())],
                    names=["doc_id", "doc_tokens", "full", "windows", "run", "length", "place", "rest"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, doc_tokens long, full array<long>, windows long, run long, length int, place long, rest binary")


def fill(pool: dict[int, int], capacity: int) -> dict[int, int]:
    """Multiset of lengths (``pool``: length and count) whose sum comes closest to ``capacity`` without passing it; long ones first."""
    full, reach, taken = (1 << capacity + 1) - 1, 1, []
    for length in sorted((x for x in pool if x <= capacity), reverse=True):
        left, step = min(pool[length], capacity // length), 1
        while left:
            k = min(step, left)
            taken.append((length, k, reach))
            reach |= (reach << length * k) & full
            left, step = left - k, step * 2
        if reach >> capacity & 1:
            break
    rest, out = reach.bit_length() - 1, {}
    for length, k, before in reversed(taken):
        if not before >> rest & 1:
            out[length] = out.get(length, 0) + k
            rest -= length * k
    return out


class Slot(NamedTuple):
    """Items of one original length, ranks ``lo`` to ``hi``: their tokens from ``start`` on stand at ``offset`` of sequences from ``sequence`` on."""

    source: int
    lo: int
    hi: int
    start: int
    size: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slot], int]:
    """Slots that hold every item once, and the number of sequences.

    All sequences are full but for the last few, which are as long as a power of two.
    """
    stock = {length: [(length, 0, 0, n)] for length, n in histogram.items() if n}  # source, start, first rank, end
    pool = {length: n for length, n in histogram.items() if n}
    slots: list[Slot] = []
    sequence = 0
    total = sum(length * n for length, n in pool.items())

    def draw(length: int, n: int, size: int, offset: int) -> None:
        """The next ``n`` items of a length give their first ``size`` tokens, one to each sequence of this round."""
        pool[length] -= n
        if not pool[length]:
            del pool[length]
        at, segments = sequence, stock[length]
        while n:
            source, start, lo, hi = segments.pop()
            k = min(n, hi - lo)
            slots.append(Slot(source, lo, lo + k, start, size, at, offset))
            if size < length:
                stock.setdefault(length - size, []).append((source, start + size, lo, lo + k))
                pool[length - size] = pool.get(length - size, 0) + k
            if lo + k < hi:
                segments.append((source, start, lo + k, hi))
            n, at = n - k, at + k

    while pool:
        room = capacity if total >= capacity else 1 << total.bit_length() - 1
        seed = max((x for x in pool if x <= room), default=0)
        use = {seed: 1} if seed else {}
        if seed:
            left = dict(pool)
            left[seed] -= 1
            for length, n in fill({x: n for x, n in left.items() if n}, room - seed).items():
                use[length] = use.get(length, 0) + n
        slack = room - sum(length * n for length, n in use.items())
        cut = max((x for x in pool if x > slack and pool[x] > use.get(x, 0)), key=lambda x: (pool[x] // (use.get(x, 0) + 1), x), default=0) if slack else 0
        need = dict(use)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(pool[length] // n for length, n in need.items())
        if room < capacity:
            times = 1
        offset = 0
        for length, n in sorted(use.items(), reverse=True):
            for _ in range(n):
                draw(length, times, length, offset)
                offset += length
        if cut:
            draw(cut, times, slack, offset)
            offset += slack
        total -= offset * times
        sequence += times
    return slots, sequence


class Shelf(NamedTuple):
    """Slots of one original length by rank: between two edges every item has the same pieces."""

    edges: np.ndarray
    first: np.ndarray  # first piece of each stretch, and the end
    pieces: np.ndarray  # start, size, sequence at the stretch's first rank, offset


def shelves(slots: list[Slot]) -> dict[int, Shelf]:
    by_source: dict[int, list[Slot]] = {}
    for s in slots:
        by_source.setdefault(s.source, []).append(s)
    out = {}
    for source, some in by_source.items():
        edges = np.unique([x for s in some for x in (s.lo, s.hi)])
        stretch: list[list[tuple[int, int, int, int]]] = [[] for _ in edges]
        for s in sorted(some, key=lambda s: s.start):
            for k in range(*np.searchsorted(edges, [s.lo, s.hi])):
                stretch[k].append((s.start, s.size, s.sequence + int(edges[k]) - s.lo, s.offset))
        first = np.r_[0, np.cumsum([len(x) for x in stretch])]
        out[source] = Shelf(edges, first, np.array([p for x in stretch for p in x], dtype=np.int64).reshape(-1, 4))
    return out


def _ahead(told: DataFrame, capacity: int) -> DataFrame:
    """``length, run, ahead``: the rests of each length, and under ``capacity`` the whole windows, that earlier runs hold."""
    held = told.filter("length > 0").groupBy("length", "run").agg(F.count(F.lit(1)).alias("n")).union(
        told.groupBy(F.lit(capacity).alias("length"), "run").agg(F.sum(F.size("full")).alias("n")))
    order = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return held.select("length", "run", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ahead"))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row for every piece of every document.

    A document is its ids and the id ``end``; a null text is an empty one and has the end id alone. Whole texts are
    tokenised; a document is cut only where it passes ``capacity`` or where its tail fills a window that no whole items fill.
    Sequences are numbered from 0; all are full, but for fewer than a dozen whose length is a smaller power of two. Rows that
    repeat a doc_id, and rows without one, are documents of their own; an empty table gives no rows.
    """
    with scratch_scope(docs.sparkSession):
        told = kept(items(docs, path, capacity=capacity, end=end), "items", lasting=True)
        rests = told.filter("length > 0")
        ahead = kept(_ahead(told, capacity), "ahead", lasting=True)
        histogram = {r["length"]: r["n"] for r in rests.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # fewer than capacity rows
    slots, sequences = plan(histogram, capacity)
    shelf = docs.sparkSession.sparkContext.broadcast(shelves(slots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length, dtype = shelf.value, word_ids(path).dtype
        for batch in batches:
            length, rank, whole = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank", "doc_tokens"))
            row, piece = [], []
            for size in np.unique(length):
                s, at = by_length[int(size)], np.flatnonzero(length == size)
                stretch = np.searchsorted(s.edges, rank[at], side="right") - 1
                n = s.first[stretch + 1] - s.first[stretch]
                one = np.repeat(np.arange(len(at)), n)
                which = np.repeat(s.first[stretch] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(one))
                found = s.pieces[which].copy()
                found[:, 2] += (rank[at] - s.edges[stretch])[one]
                row.append(at[one])
                piece.append(found)
            if not row:
                continue
            row, piece = np.concatenate(row), np.concatenate(piece)
            raw = batch.column("rest").to_pylist()
            crc = [checksum(np.frombuffer(raw[r], dtype=dtype)[a:a + n]) for r, a, n in zip(row.tolist(), piece[:, 0].tolist(), piece[:, 1].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece[:, 0] + (whole - length)[row]), pa.array(piece[:, 1]), pa.array(crc, pa.int64()),
                 pa.array(whole[row]), pa.array(piece[:, 2]), pa.array(piece[:, 3])], names=[c.split()[0] for c in PIECES.split(", ")])

    ranked = rests.join(ahead, ["length", "run"]).withColumn("rank", F.col("ahead") + F.col("place"))
    placed = ranked.select("doc_id", "doc_tokens", "length", "rank", "rest").mapInArrow(place, PIECES)
    # a whole window is a sequence of its own, after the packed ones
    wide = told.filter(F.size("full") > 0).join(ahead.filter(F.col("length") == capacity).select("run", "ahead"), "run")
    alone = wide.select("doc_id", "doc_tokens", (F.col("ahead") + F.col("windows") + sequences).alias("at"), F.posexplode("full").alias("k", "crc")).select(
        "doc_id", (F.col("k") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        "doc_tokens", (F.col("at") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.union(alone)
