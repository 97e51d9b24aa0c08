"""SentencePiece encoding and decoding for merge-type vocabularies.

An agenda of adjacent symbol pairs, ordered by the score of the piece they would form and then from the
left, decides every merge. No piece holds the space mark after another character, so a text falls apart
into chunks (space marks and what follows) whose agendas do not touch; equal chunks are encoded once.
Short chunks of a batch keep their agendas side by side in arrays, long ones use a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from sparkmine.llm.common import slices

SPACE = "▁"
LETTERS = "A-Za-z\u00c0-\u024f"
NONE = np.int64(1) << 40
LONG = 64
#: bytes of text that are cut into chunks at a time, and chunks remembered between them
SLICE = 1 << 20
CACHE = 60_000
PROBES = ("", " ", "a  b", " ﬁé ", "x\n\n\ty", "\U0001f642漢 　z", "<s></s><unk><0x41>")


class Pieces:
    """The vocabulary of a model file and the merges that it allows."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        fixed = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces are not supported")
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.unknown = sp.unk_id()
        self.id = {t: i for i, t in enumerate(self.text) if not fixed[i]}
        if any(SPACE in t.lstrip(SPACE) for t in self.id):
            raise ValueError("a piece crosses a space")
        symbols = dict(self.id)
        for t in self.id:
            for c in t:
                symbols.setdefault(c, len(self.text) + len(symbols))
        self.symbol = symbols
        scores = sorted({sp.get_score(i) for i in self.id.values()}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        merges = {}
        for t, i in self.id.items():
            for k in range(1, len(t)):
                a, b = symbols.get(t[:k]), symbols.get(t[k:])
                if a is not None and b is not None:
                    merges[a, b] = (place[sp.get_score(i)], i)
        self.merges = merges
        pairs = np.array([(a << 32) | b for a, b in merges] or [-1], dtype=np.int64)
        order = np.argsort(pairs)
        value = np.array([(r << 20) | i for r, i in merges.values()] or [0], dtype=np.int64)
        self.pair, self.merged = pairs[order], value[order]  # rank and piece in one number
        self.code = {c: symbols[c] for c in symbols if len(c) == 1}
        self.code_of = np.full(0x110000, -1, dtype=np.int64)
        for c, i in self.code.items():
            self.code_of[ord(c)] = i
        # where no piece holds a letter next to a mark or digit, chunks part there as well
        mixed = re.compile(f"[{LETTERS}][^{LETTERS}{SPACE}]|[^{LETTERS}{SPACE}][{LETTERS}]")
        parted = f"{SPACE}*[{LETTERS}]+|{SPACE}*[^{LETTERS}{SPACE}]+|{SPACE}+"
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if any(mixed.search(t) for t in self.id) else parted)
        for probe in PROBES:
            if self.join(probe) != sp.encode(probe):
                raise ValueError("this model rewrites or splits texts in a way that is not supported")

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def join(self, text: str) -> list[int]:
        parts = self.chunks(text)
        return [i for ids in self.encode(parts) for i in ids]

    def finish(self, symbols, chars: str) -> list[int]:
        """Pieces as ids; characters outside the vocabulary as bytes."""
        size, out, at = len(self.text), [], 0
        if all(0 <= s < size for s in symbols):
            return symbols
        for s in symbols:
            if 0 <= s < len(self.text):
                out.append(s)
                at += len(self.text[s])
            else:
                raw = chars[at].encode("utf-8")
                out += [self.byte[b] for b in raw] if self.byte else [self.unknown]
                at += 1
        return out

    def encode(self, chunks: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(chunks)
        short = [k for k, c in enumerate(chunks) if len(c) <= LONG]
        for k, c in enumerate(chunks):
            if len(c) > LONG:
                out[k] = self.finish(self.heap_agenda(c), c)
        for k, symbols in zip(short, self.array_agenda([chunks[k] for k in short])):
            out[k] = self.finish(symbols, chunks[k])
        return out

    def heap_agenda(self, chars: str) -> list[int]:
        sym = [self.code.get(c, -1) for c in chars]
        n = len(sym)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and (m := self.merges.get((sym[a], sym[b]))):
                heapq.heappush(agenda, (m[0], a, b, sym[a], sym[b], m[1]))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, a, b, x, y, piece = heapq.heappop(agenda)
            if not (alive[a] and alive[b] and sym[a] == x and sym[b] == y and after[a] == b):
                continue
            sym[a], alive[b], after[a] = piece, False, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s, ok in zip(sym, alive) if ok]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        key[(a < 0) | (b < 0)] = -1
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (key >= 0), self.merged[at], NONE)

    def array_agenda(self, chunks: list[str]) -> list[list[int]]:
        """One merge in each chunk a round: the best-scored pair, the leftmost of equals."""
        if not chunks:
            return []
        sym = self.code_of[np.frombuffer("".join(chunks).encode("utf-32-le"), dtype=np.uint32)]
        of = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        best = np.full(len(sym), NONE)
        if len(sym) > 1:
            best[:-1] = np.where(of[:-1] == of[1:], self.look_up(sym[:-1], sym[1:]), NONE)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lengths = np.diff(np.r_[starts, len(sym)])
            rank = best >> 20
            low = np.minimum.reduceat(rank, starts)
            live = np.repeat(low < (NONE >> 20), lengths)
            if not live.all():
                done.append((of[~live], sym[~live]))
                sym, of, best, rank = sym[live], of[live], best[live], rank[live]
                lengths, low = lengths[low < (NONE >> 20)], low[low < (NONE >> 20)]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, lengths))
            first = hits[np.r_[True, of[hits[1:]] != of[hits[:-1]]]]
            sym[first] = best[first] & ((1 << 20) - 1)
            keep = np.ones(len(sym), dtype=bool)
            keep[first + 1] = False
            at = first - np.arange(len(first))  # places after the removals
            sym, of, best = sym[keep], of[keep], best[keep]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(sym) - 1)
                same = (of[left] == of[right]) & (right > left)
                best[left] = np.where(same, self.look_up(sym[left], sym[right]), NONE)
        of, sym = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(of, kind="stable")
        counts = np.bincount(of, minlength=len(chunks))
        flat, ends = sym[order].tolist(), np.cumsum(counts).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids that start at the start of a text; runs of bytes are read as UTF-8."""
        if self.of_byte.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).replace(SPACE, " ")
        out, raw = [], bytearray()
        for i in ids:
            if i in self.of_byte:
                raw.append(self.of_byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.text[i])
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_frame(docs: DataFrame, path: str, *, keep: str = "doc_id long", text_col: str = "text", ids: bool = False) -> DataFrame:
    """``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``ids``, the ids themselves for every text.

    ``keep`` lists the columns carried along. A null text is an empty one: no ids, the digests of nothing.
    Whole texts of any length are encoded; repeated rows give repeated rows; an empty table gives none.
    One text of every slice is also encoded and decoded by the library, and a difference raises.
    """
    names = [c.split()[0] for c in keep.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = pieces(path), {}
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                cut = [model.chunks(t) for t in texts]
                if len(cache) > CACHE:
                    cache.clear()
                new = list({c for chunks in cut for c in chunks if c not in cache})
                for c, found in zip(new, model.encode(new)):
                    cache[c] = (",".join(map(str, found)), len(found), model.decode(found))
                rows = []
                for k, (text, chunks) in enumerate(zip(texts, cut)):
                    got = [cache[c] for c in chunks]
                    listed, plain = ",".join([g[0] for g in got]), "".join([g[2] for g in got])[1:]
                    rows.append((sum([g[1] for g in got]), sha(listed), sha(plain), listed))
                    if k == 0:
                        theirs = model.library.encode(text)
                        if listed != ",".join(map(str, theirs)) or plain != model.library.decode(theirs):
                            raise AssertionError("the agenda and the library differ")
                out = [part.column(n) for n in names]
                out += [pa.array([r[k] for r in rows], type=t) for k, t in ((0, pa.int64()), (1, pa.string()), (2, pa.string()))]
                fields = [*names, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    out.append(pa.array([[int(i) for i in r[3].split(",") if i] for r in rows], type=pa.list_(pa.int32())))
                    fields.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=fields)

    schema = f"{keep}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, schema)
