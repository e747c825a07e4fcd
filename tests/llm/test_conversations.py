import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def ordered(rows):
    def digest(r):
        conv = "" if r[0] is None else f"={r[0]}"
        return hashlib.sha256(f"{conv}\n{len(r[2])}\n{r[2]}{r[3]}".encode()).digest()

    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))


def brute(rows):
    """Every prefix of every state, place by place: least (cost, audit, repaired rows)."""
    at = {"": (0, "", ())}
    seen, counts = set(), dict(blank=0, duplicate=0, truncated=0)

    def step(state, initial):
        return {"s": "s", "u": "u"}.get(initial) if state == "" else {"su": "u", "ua": "a", "au": "u"}.get(state + initial)

    def inserts(found):
        for _ in range(4):
            for state, (c, a, r) in list(found.items()):
                for role in ("user", "assistant"):
                    to = step(state, role[0])
                    new = (c + 5, a + "I", (*r, (role, "")))
                    if to and (to not in found or new < found[to]):
                        found[to] = new
        return found

    for _, _, role, text in rows:
        body = text.strip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        then = {}
        for state, (c, a, r) in inserts(at).items():
            ways = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                ways += [(step(state, role[:1]), extra, "K", ((role, text),))]
                ways += [(step(state, x[0]), 1 + extra, "R", ((x, text),)) for x in ("user", "assistant")]
            for to, cost, edit, kept in ways:
                new = (c + cost, a + edit, r + kept)
                if to is not None and (to not in then or new < then[to]):
                    then[to] = new
        at = then
    cost, audit, kept = min(v for s, v in inserts(at).items() if s in ("", "a"))
    turns = {t for _, t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)


def expected(rows, hurt=True):
    by = defaultdict(list, {r[0]: [] for r in rows})
    for r in damaged(rows) if hurt else rows:
        by[r[0]].append(tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)))
    return {c: brute(ordered(v)) for c, v in by.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(spark, rows, segment=C.SEGMENT, schema=SCHEMA):
    out = C.repair(C.damage(spark.createDataFrame(rows, schema)), segment)
    assert out.columns == ["conv_id", *COLUMNS]
    found = [(r["conv_id"], tuple(r[c] for c in COLUMNS)) for r in out.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def made(seed, convs, longest):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((c, t + 2 * (rng.random() < 0.1), role, rng.choice(["Yes.", "No!", "Maybe", "", " \n", "Why? ", "It is so.", "a longer text.\n", None])))
    return rows


@pytest.mark.parametrize("segment", [1, 3, C.SEGMENT])
def test_against_brute_force(spark, segment):
    rows = made(segment, 60, 25) + [(1000, t, "user" if t % 2 else "assistant", f"text {t % 90}.") for t in range(400)]
    assert got(spark, rows, segment) == expected(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(spark, rows) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (None, 4, "user", "Hi."),
        (1, 5, "user", None), (2, None, "assistant", "A."), (2, None, "system", "B."), (2, 7, "user", "C"), (2, 7, "user", "C."),
        (3, -(2**63), "user", "x."), (4, 1, "user", "y" * 300_000), (4, 2, "assistant", "z." * 100_000), (5, 1, "s:ystem", "a"), (5, 2, "s", ":ystema"),
    ]
    rows += [(6, 9, "assistant", "same.")] * 50 + [(7, None, "assistant", "n.")] * 5
    assert got(spark, rows) == expected(rows)
    extra = [(*r, "k", 1, "s") for r in rows]
    assert got(spark, extra, schema=SCHEMA + ", kind string, n int, digest string") == expected(rows)
    assert got(spark, []) == {}


def test_repaired_rows(spark):
    rows = made(9, 20, 12)
    df = spark.createDataFrame(rows, SCHEMA)  # undamaged: no copies column
    out = C.repaired(df, C.summaries(df)).collect()
    by = defaultdict(list)
    for r in out:
        by[r.conv_id].append(r)
    want = expected(rows, hurt=False)
    for c, (*_, audit, sha) in want.items():
        kept = by.get(c, [])
        assert [r.place for r in kept] == list(range(len(kept)))
        assert "".join(r.edit for r in kept) == audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == sha


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.booleans()), max_size=14), st.integers(0, 2))
def test_search_is_optimal(items, tail):
    rows, k = [], 0
    for lead, code, cut in items:
        rows += [(0, 0, "x", "")] * lead
        k += 1
        rows.append((0, 0, "tsua"[code], f"{k}" + ("" if cut else ".")))
    rows += [(0, 0, "x", "")] * tail
    assert C.search(items, tail, C.START, C.ENDS) == brute(rows)[5:7]


def test_search_of_a_long_part_ends_soon():
    rng = random.Random(3)
    items = [(0, rng.randrange(4), rng.random() < 0.3) for _ in range(C.SEGMENT)]
    found = C.search(items, 0, C.START, C.ENDS)
    rows = [(0, 0, "tsua"[code], f"{i}" + ("" if cut else ".")) for i, (_, code, cut) in enumerate(items)]
    assert found == brute(rows)[5:7]
