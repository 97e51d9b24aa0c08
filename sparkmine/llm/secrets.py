"""Secret scan: fixed patterns, and a guess-cost estimate for the values that follow credential words.

The guess cost of a value is the cheapest way to cut it into dictionary words, dates, repeats, keyboard walks and
brute-force spans (minimum over all segmentations, by dynamic programming); a value that is expensive to guess is
taken for a secret, a cheap one for prose.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import slices

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|bearer|auth)"""
    r"""["']?[ \t]*(?:[:=]|\bis\b)[ \t]*["']?([^\s"'<>]{8,})""", re.I | re.A)
#: log10 of the guesses above which a credential value counts as a secret
MIN_COST = 10.0
#: words that start the dictionary; the most frequent words of the texts follow, see ``vocabulary``
COMMON = (
    "password the and you for admin with that this welcome letmein login user test example secret token access key "
    "change placeholder your here none null true false master root guest default hello world dragon monkey love "
    "name value string number required optional expired invalid reset forgot account email from incorrect correct wrong "
    "missing protected necessary important available encrypted secure well known stored hidden").split()
#: words taken from the texts, and their longest
DICTIONARY, LONGEST = 20_000, 24
DATE = re.compile(r"(?:19|20)\d{2}[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)?\d{2}|(?:19|20)\d{2}")
LEET = str.maketrans("013457@$", "oleastas")
#: a keyboard: rows from the top, each shifted by half a key against the one above
ROWS, SHIFTED = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"), str.maketrans("!@#$%^&*()", "1234567890")
#: ends of a span that are tried; a longer repeat or walk counts as a whole
ENDS = 64


def _steps() -> dict[str, int]:
    """Two keys that touch, and the direction from the first to the second."""
    key = {c: (x, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    near = {(1, 0): 0, (-1, 0): 1, (0, 1): 2, (0, -1): 3, (-1, 1): 4, (1, -1): 5}  # along a row, down and up to the two keys that touch
    return {a + b: near[q[0] - p[0], q[1] - p[1]] for a, p in key.items() for b, q in key.items() if (q[0] - p[0], q[1] - p[1]) in near}


STEPS = _steps()


class Dictionary(dict):
    """Rank of every word, from 1 on."""

    def __init__(self, words: Iterable[str] = ()):
        super().__init__()
        for w in (*COMMON, *words):
            self.setdefault(w, len(self) + 1)
        self.longest = max(map(len, self))


def _run(holds: list[bool]) -> list[int]:
    """For each place how many places from there on hold without a break."""
    out = [0] * (len(holds) + 1)
    for i in range(len(holds) - 1, -1, -1):
        out[i] = out[i + 1] + 1 if holds[i] else 0
    return out


def lowered(value: str) -> str:
    """Lower case, place for place."""
    low = value.lower()
    return low if len(low) == len(value) else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def brute_cost(c: str) -> float:
    return 1.0 if c.isdigit() else 1.15 if c.isascii() and c.islower() else 1.3


def word_cost(rank: int, extra: float) -> float:
    return math.log10(rank * 2) + extra


def walk_cost(length: int, turns: int) -> float:
    return 2.0 + math.log10(length) + 0.9 * turns


def repeat_cost(unit: str, times: float) -> float:
    return sum(map(brute_cost, unit)) + math.log10(times)


def _ends(first: int, last: int) -> Iterable[int]:
    return range(first, last + 1) if last - first < ENDS else (*range(first, first + ENDS), last)


def _spans(value: str, period: int, words: Dictionary) -> Iterator[tuple[int, int, float]]:
    """Cheap spans of a value: ``(start, end, log10 guesses)``; what repeats has up to ``period`` characters."""
    low, n = lowered(value), len(value)
    plain, keys = low.translate(LEET), low.translate(SHIFTED)
    step = [STEPS.get(keys[i:i + 2], -1) for i in range(n - 1)]
    same = {size: _run([value[i] == value[i + size] for i in range(n - size)]) for size in range(1, period + 1)}
    for i in range(n):
        for j in range(i + 2, min(n, i + words.longest) + 1):
            for text, extra in ((low, 0.0), (plain, 0.6)):
                if (rank := words.get(text[i:j])) is not None:
                    yield i, j, word_cost(rank, extra + (0.0 if value[i:j] == low[i:j] else 0.3))
        if (m := DATE.match(value, i)):
            yield i, m.end(), 2.1 if m.end() - i == 4 else 4.6
        turns, j = 0, i
        while j < n - 1 and step[j] >= 0 and j - i < ENDS:
            turns += j > i and step[j] != step[j - 1]
            j += 1
            if j - i >= 2:
                yield i, j + 1, walk_cost(j + 1 - i, turns)
        for size in range(1, min(period, n - i) + 1):
            for j in _ends(i + max(3, 2 * size), i + size + same[size][i]):
                yield i, j, repeat_cost(value[i:i + size], (j - i) / size)


def guess_cost(value: str, limit: float = math.inf, words: Dictionary | None = None) -> float:
    """log10 of the guesses for the cheapest segmentation; any single character costs a factor of ten or more.

    With ``limit`` it is right as far as being below it goes: a repeat of so many characters costs more by itself,
    so that only shorter ones are looked for and the time is linear in the length.
    """
    n = len(value)
    words = WORDS if words is None else words
    best = [0.0] + [math.inf] * n
    by_end: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in _spans(value, int(min(n // 2, math.ceil(limit)) if limit < math.inf else n // 2), words):
        by_end.setdefault(j, []).append((i, cost))
    for j in range(1, n + 1):
        best[j] = best[j - 1] + brute_cost(value[j - 1])
        for i, cost in by_end.get(j, ()):
            best[j] = min(best[j], best[i] + cost)
    return best[n]


WORDS = Dictionary()


def vocabulary(docs: DataFrame, *, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The ``size`` words that stand most often in all texts, elsewhere than as the value of a credential word.

    Words are runs of letters in lower case, three to ``LONGEST`` of them; ties go by the word. A value that is copied
    with its document thousands of times does not become a word by that.
    """
    bare = F.regexp_replace(F.coalesce(text_col, F.lit("")), f"(?i){CONTEXT.pattern}", " ")
    word = docs.select(F.explode(F.split(F.lower(bare), r"[^\p{L}]+")).alias("w")).filter(F.length("w").between(3, LONGEST))
    top = word.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r["w"] for r in top.select("w").collect()]


def find(text: str, min_cost: float = MIN_COST, words: Dictionary | None = None) -> list[tuple[int, int, int]]:
    """Spans ``(start, kind, end)`` in code points, in order of start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = list(out)
    for m in CONTEXT.finditer(text):
        a, b = m.span(1)
        while b > a and text[b - 1] in ".,;:!?)":
            b -= 1
        value = text[a:b]
        if b - a >= 8 and not any(s <= a and b <= e for s, _, e in base) and guess_cost(value, min_cost, words) >= min_cost:
            out.append((a, 3, b))
    return sorted(out)


def scan(docs: DataFrame, *, keep: str = "doc_id long", text_col: str = "text", min_cost: float = MIN_COST, redact: str | None = None) -> DataFrame:
    """Secrets of every whole text: counts and spans per kind; with ``redact`` also the text with each span replaced.

    A null text is an empty one (no spans; ``redacted`` stays null). Overlapping spans are replaced as one. Every
    row is judged alone, against the dictionary of all texts, so repeated rows, ties and an empty table need no rule;
    ``keep`` lists carried columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(docs, text_col=text_col))
    names = [c.split()[0] for c in keep.split(",")]

    def clean(text: str | None, spans) -> str | None:
        if text is None or not spans:
            return text
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [text[at:a], redact]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Dictionary(shared.value)
        listed = lambda s: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in s)
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                found = [find(t, min_cost, words) if t else [] for t in texts]
                base = [listed([x for x in s if x[1] < 3]) for s in found]
                out = [part.column(n) for n in names]
                out += [pa.array([sum(x[1] == k for x in s) for s in found], type=pa.int64()) for k in range(4)]
                out += [pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], type=pa.string())]
                out += [pa.array([listed(s) for s in found], type=pa.string())]
                fields = [*names, "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"]
                if redact is not None:
                    out.append(pa.array([clean(t, s) for t, s in zip(texts, found)], type=pa.string()))
                    fields.append("redacted")
                yield pa.RecordBatch.from_arrays(out, names=fields)

    schema = f"{keep}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"
    schema += ", redacted string" if redact is not None else ""
    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, schema)
