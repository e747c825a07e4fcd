import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tabwright.llm import secrets

RANK = {w: i for i, w in enumerate(secrets.COMMON, 1)}
LONGEST = max(map(len, RANK))


@pytest.mark.parametrize(
    "value, most",
    [("password", 1), ("P@ssw0rd!", 4), ("qwertyuiop", 4), ("19901231", 5), ("aaaaaaaaaaaa", 3), ("welcome2024", 4), ("abcdefghij", 4)],
)
def test_weak_values_are_cheap(value, most):
    assert secrets.guess_cost(value, RANK, LONGEST)[0] < most


@pytest.mark.parametrize("value", ["x7#Kq!9zLm", "24be64439e3e49cf46b2d7c9", "gH7_pQ2-vN9x"])
def test_random_values_are_dear(value):
    assert secrets.guess_cost(value, RANK, LONGEST)[0] > 10


def test_least_cost_over_all_segmentations():
    """Against all ways to cut short values into known words and brute-force runs."""
    rng, rank = random.Random(1), {"ab": 1, "abc": 7, "ca": 3, "bca": 40}

    def cost(part):
        known = secrets.word_cost(part, rank) if len(part) > 2 else None
        plain = sum(map(secrets.char_cost, part))
        return plain if known is None else min(known, plain)

    for _ in range(30):
        value = "".join(rng.choice("abcx") for _ in range(7))
        if any((a, b) in secrets._NEXT for a, b in itertools.pairwise(value)) or re.search(r"(.+)\1", value):
            continue
        best = math.inf
        for cuts in itertools.product((0, 1), repeat=6):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(value[last:i])
                    last = i
            parts.append(value[last:])
            best = min(best, sum(map(cost, parts)) + secrets.JOINT * (len(parts) - 1))
        assert secrets.guess_cost(value, rank, 4)[0] == pytest.approx(best)


def plain_spans(text):
    out = [("assign", *m.span()) for m in re.finditer(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    bits = ["token", "API_KEY", "passwd", "ſecret", "secret", " = ", ": ", '"', "AKIA", "ABCD1234", "deadbeef", "0f" * 12, " ", "é", "🎉", "zz", "AKIAAKIA", "'", "=="]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert [s[:3] for s in secrets.spans(text, RANK, LONGEST) if s[0] != "guess"] == plain_spans(text)


def test_guessed_values():
    text = 'pwd: "x7#Kq!9zLm" and password = "password123" and https://bob:gH7!pQ2-vN9x@host/'
    found = [text[a:b] for k, a, b, _ in secrets.spans(text, RANK, LONGEST) if k == "guess"]
    assert found == ["x7#Kq!9zLm", "gH7!pQ2-vN9x"]


def test_cues_leave_out_no_context(monkeypatch):
    rng = random.Random(5)
    bits = ["password", "PassPhrase", "passcode", "pwd", "pin", "secret", "token", "credentials", "api_key", "access-key", "authorization", "login", "Bearer", "Basic"]
    bits += ["curl -H", " ", " ", ": ", " = ", "=>", "x://bob:", "@host", '"', "x7#Kq!9zLm", "QWxhZGRpbjpvcGVuIHNlc2FtZTEyMw==", "gH7_pQ2-vN9x"]
    texts = ["curl -H Basic QWxhZGRpbjpvcGVuIHNlc2FtZTEyMw==", *("".join(rng.choice(bits) for _ in range(rng.randrange(2, 8))) for _ in range(3000))]
    found = [secrets.spans(t, RANK, LONGEST) for t in texts]
    monkeypatch.setattr(secrets, "CUES", ("",))
    assert found == [secrets.spans(t, RANK, LONGEST) for t in texts]
    assert any(k == "guess" for k, *_ in found[0])


def test_frames(docs_of, odd_rows):
    docs = docs_of([(*r, "x") for r in odd_rows], ", spans string")
    out = secrets.scan(docs)
    assert out.count() == len(odd_rows)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans"]
    long = docs_of([(1, "é🎉 token = " + "a1b2c3d4" * 20_000, "en", "s", 0)])
    got = secrets.scan(long).first()["spans"]
    assert [(s.kind, s.start, s.stop) for s in got] == [("assign", 3, 160_011), ("hex", 11, 160_011), ("guess", 11, 160_011)]
    assert secrets.scan(docs_of([])).count() == 0


def test_first_by_is_exact(spark):
    """Against sorting everything, at borders within and between ranks."""
    from tabwright.llm.base import first_by

    rows = [(i, i % 7 if i % 3 else 1000 + i) for i in range(400)]
    table = spark.createDataFrame(rows, "w int, n int")
    all_ = sorted((-r.n, r.h, r.w) for r in table.select("*", F.xxhash64("w", "n").alias("h")).collect())
    for k in (0, 1, 50, 266, 267, 399, 400, 1000):
        assert [r["w"] for r in first_by(table, F.col("n"), k)] == [w for _, _, w in all_[:k]]
    assert first_by(table.filter("false"), F.col("n"), 5) == []
