"""Secret scan: fixed patterns, and guess costs of the values that stand where credentials do."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.base import first_by, text_of
from tabwright.session import settle

KINDS = ("assign", "access", "hex", "guess")
#: Corpus words that the guesser knows, by frequency.
WORDS = 20_000
#: Decimal logarithm of the guesses from which a value counts as a secret.
MIN_COST = 8.0
#: Cost of starting another segment.
JOINT = 0.3
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("stop", "long").add("cost", "double"))

# The base patterns of the scan.
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without any of these, in lower case, has neither an assignment nor another credential context.
CUES = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "basic", "credential", "login", "pin", "://")

_NAME = (
    r"(?<![A-Za-z0-9])(?ai:(?:[a-z0-9]+[_.-])*(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|"
    r"(?:api|access|private|secret|auth)[_-]?key|auth(?:orization)?|login))(?:[\"'])?"
)
#: Where a value follows that somebody may have to guess; group v is the value.
CONTEXTS = (
    re.compile(_NAME + r"\x20*(?:=>|:=|[:=])\x20*(?:\"(?P<v>[^\"\n]{6,})\"|'(?P<w>[^'\n]{6,})'|(?P<x>[^\s\"',;<>(){}\[\]]{6,}))"),
    re.compile(r"(?<![A-Za-z0-9])(?ai:bearer|basic)\x20+(?P<v>[A-Za-z0-9+/_.=~-]{6,})"),
    re.compile(r"://[^\s/:@\"'<>]+:(?P<v>[^\s/@\"'<>]{6,})@"),
)

# Passwords and parts of passwords in common use, most common first.
COMMON = """password qwerty admin welcome letmein monkey dragon master login abc iloveyou princess football
sunshine shadow superman michael jordan hunter baseball trustno hello charlie secret summer winter spring
autumn test guest root user default changeme access starwars killer freedom whatever ninja mustang
jesus love pass""".split()  # fmt: skip
# Rows of keys, and orders, along which people walk.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp", "1q2w3e4r5t6y7u8i9o0p")
_LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"})
_DATE = re.compile(
    r"(?:19|20)\d\d([-/. ]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/. ]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])([-/. ]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d|(?:0[1-9]|[12]\d|3[01])([-/.])(?:0[1-9]|1[0-2])\4\d\d"
)
_YEAR = re.compile(r"(?:19|20)\d\d")
_NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}
_NEXT |= {(b, a) for a, b in _NEXT}
_DAYS, _YEARS = math.log10(365.25 * 120), math.log10(120)
_STEP = math.log10(4.6)


def char_cost(c: str) -> float:
    """Guesses for one character by itself: the size of its class."""
    if "0" <= c <= "9":
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if c < "\x80" else 3.0


def word_cost(part: str, rank: dict[str, int]) -> float | None:
    """Guesses for a word: its rank, its capitals and its substituted letters; None if unknown."""
    low = part.lower()
    r, swaps = rank.get(low), 0
    if r is None:
        plain = low.translate(_LEET)
        r = rank.get(plain)
        if r is None or len(plain) != len(low):
            return None
        swaps = sum(a != b for a, b in zip(low, plain, strict=True))
    ups = sum(c.isupper() for c in part)
    shape = 0.0 if not ups else math.log10(2) if ups == len(part) or (ups == 1 and part[0].isupper()) else ups * math.log10(2) + 0.3
    return math.log10(r + 1) + shape + swaps * math.log10(2)


def guess_cost(value: str, rank: dict[str, int], longest: int) -> tuple[float, list[tuple[int, int, str]]]:
    """The least decimal logarithm of guesses over all segmentations of ``value``, and the best segmentation.

    Segments are known words, dates and years, repeats of a shorter unit, walks along keys
    or the alphabet, and brute-force characters. Every segment after the first costs JOINT more, runs of
    brute-force characters only once. Time is linear in the length of the value, times
    the longest word.
    """
    n = len(value)
    ends: dict[int, list[tuple[int, float, str]]] = {}

    def add(i: int, j: int, cost: float, kind: str) -> None:
        ends.setdefault(j, []).append((i, cost, kind))

    for pattern, cost, kind in ((_DATE, _DAYS, "date"), (_YEAR, _YEARS, "date")):
        for i in range(n - 3):
            if value[i].isdigit() and (m := pattern.match(value, i)):
                add(i, m.end(), cost, kind)
    low = value.lower()
    i = 0
    while i < n - 2:  # walks: every piece of three or more of the longest runs
        j = i
        while j + 1 < n and (low[j], low[j + 1]) in _NEXT:
            j += 1
        for a in range(i, j - 1):
            for b in range(a + 3, min(j + 1, a + 48) + 1):
                ups = sum(c.isupper() for c in value[a:b])
                add(a, b, math.log10(47) + _STEP + math.log10(b - a) + ups * 0.3, "walk")
        i = max(j, i + 1)
    for unit in range(1, min(9, n // 2 + 1)):  # repeats: the longest runs of each period, cut at whole units
        i = 0
        while i + unit < n:
            j = i
            while j + unit < n and value[j] == value[j + unit]:
                j += 1
            times = (j - i) // unit + 1
            if times >= (3 if unit == 1 else 2):
                base = sum(map(char_cost, value[i : i + unit]))
                for t in range(2 if unit > 1 else 3, times + 1) if times <= 64 else (times,):
                    add(i, i + t * unit, base + math.log10(t), "repeat")
            i = j + 1
    best, back = [0.0] + [math.inf] * n, [(0, "")] * (n + 1)
    brute = [math.inf] * (n + 1)  # least cost of segmentations that end in a brute-force character
    came: list[int] = [0] * (n + 1)
    for j in range(1, n + 1):
        c = char_cost(value[j - 1])
        fresh = best[j - 1] + (JOINT if j > 1 else 0.0) + c
        brute[j], came[j] = (brute[j - 1] + c, came[j - 1]) if brute[j - 1] + c <= fresh else (fresh, j - 1)
        best[j], back[j] = brute[j], (came[j], "brute")
        for i in range(max(0, j - longest), j - 2):
            cost = word_cost(value[i:j], rank)
            if cost is not None and (total := best[i] + (JOINT if i else 0.0) + cost) < best[j]:
                best[j], back[j] = total, (i, "word")
        for i, cost, kind in ends.get(j, ()):
            if (total := best[i] + (JOINT if i else 0.0) + cost) < best[j]:
                best[j], back[j] = total, (i, kind)
    path, j = [], n
    while j:
        i, kind = back[j]
        path.append((i, j, kind))
        j = i
    return best[n], path[::-1]


def spans(text: str, rank: dict[str, int], longest: int, min_cost: float = MIN_COST) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) by start and then kind. Base kinds span the whole match, guessed ones the value."""
    found: list[tuple[str, int, int, float | None]] = []
    low = text.lower()
    if any(c in low for c in CUES):
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        seen = set()
        for pattern in CONTEXTS:
            for m in pattern.finditer(text):
                group = next(g for g in ("v", "w", "x") if g in pattern.groupindex and m.start(g) >= 0)
                if m.span(group) not in seen:
                    seen.add(m.span(group))
                    cost = guess_cost(m[group], rank, longest)[0]
                    if cost >= min_cost:
                        found.append(("guess", *m.span(group), cost))
    if "AKIA" in text:
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def word_ranks(docs: DataFrame, words: int = WORDS) -> dict[str, int]:
    """Ranks from 1 of the common passwords and then the most frequent words of all texts, ``words`` of them at most.

    Of equally frequent words at the border those with the smallest hashes are taken.
    """
    each = F.explode(F.regexp_extract_all(F.lower(text_of()), F.lit("[a-z]{3,24}"), F.lit(0))).alias("w")
    seen = settle(docs.select(each).groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")
    rank = {w: i for i, w in enumerate(COMMON, 1)}
    for r in sorted(first_by(seen, F.col("n"), words), key=lambda r: (-r["n"], r["w"])):
        rank.setdefault(r["w"], len(rank) + 1)
    return rank


def scan(docs: DataFrame, rank: dict[str, int] | None = None, min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, start, stop, cost) in code points, end exclusive.

    Kinds assign, access and hex follow the base patterns. Kind guess marks a value in a
    credential context whose least guess cost, over words, dates, repeats, keyboard walks
    and brute force, is 10**min_cost or more. ``rank`` has the known words; by default
    those most frequent in ``docs``.

    Null and empty texts have no spans. Rows are independent. A column named spans is replaced. Values are
    scored at any length. An empty table stays empty.
    """
    rank = word_ranks(docs) if rank is None else rank
    spark = docs.sparkSession
    longest = max(map(len, rank), default=0)
    known = spark.sparkContext.broadcast(rank)
    docs = docs.drop("spans")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("cost", pa.float64())]))
        for batch in batches:
            out = []
            for t in batch.column("text"):
                got = spans(t.as_py() or "", known.value, longest, min_cost)
                out.append([dict(zip(("kind", "start", "stop", "cost"), s, strict=True)) for s in got])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*names, "spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("spans", SPANS)]))
