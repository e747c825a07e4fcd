import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabwright.llm import ppm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def brute(rows, order):
    """The base by counters; the model by walking contexts symbol by symbol."""
    train = [lower(t) for i, t in rows if not held_out(i)]
    words = Counter(w for t in train for w in WORD.findall(t))
    ends = len(train)
    total, kinds = sum(words.values()) + ends, len(words) + (ends > 0)
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        b = [ppm.START] * order + list(t.encode()) + [ppm.END]
        for k in range(order + 1):
            for i in range(order, len(b)):
                seen[k][tuple(b[i - k : i])][b[i]] += 1
    out = {}
    for i, t in rows:
        t = lower(t)
        toks = WORD.findall(t)
        plain = sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in [*(words[w] for w in toks), ends])
        b, deep = [ppm.START] * order + list(t.encode()) + [ppm.END], 0.0
        for at in range(order, len(b)):
            out_of = set()
            for k in range(order, -1, -1):
                counts = seen[k].get(tuple(b[at - k : at]), {})
                rest = {s: c for s, c in counts.items() if s not in out_of}
                if not rest:
                    continue
                whole = sum(rest.values()) + len(rest)
                if b[at] in rest:
                    deep += math.log10(rest[b[at]] / whole)
                    break
                deep += math.log10(len(rest) / whole)
                out_of |= set(rest)
            else:
                deep -= math.log10(max(1, 256 - len(out_of)))
        out[i] = (held_out(i), len(toks) + 1, sum(words[w] > 0 for w in toks) + (ends > 0), total, plain, deep)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé ñ") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    some = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    return [*some, (60, None), (61, ""), (62, "Zebra\x00 \t\n ABA"), (63, "qqqq ωω")]


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_equals_brute_force(docs_of, rows, monkeypatch, chunk):
    monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk * 300)
    docs = docs_of([(i, t, "en", "s", 0) for i, t in rows]).repartition(3)
    got = {r.doc_id: r for r in ppm.score(docs).collect()}
    for i, (held, n, known, total, plain, deep) in brute(rows, ppm.ORDER).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(plain, abs=1e-9)
        assert r.score == pytest.approx(deep, abs=1e-9), i


def test_no_context_is_left_out_however_many_there_are(docs_of, rows, monkeypatch):
    """Every level holds far more symbols than a level once could hold."""
    monkeypatch.setattr(ppm, "LEVEL_SYMBOLS", 40, raising=False)
    monkeypatch.setattr(ppm, "GROUPS", 3, raising=False)
    got = {r.doc_id: r.score for r in ppm.score(docs_of([(i, t, "en", "s", 0) for i, t in rows])).collect()}
    for i, (*_, deep) in brute(rows, ppm.ORDER).items():
        assert got[i] == pytest.approx(deep, abs=1e-9), i


def test_probabilities_add_up_to_one(rows):
    seen = [Counter() for _ in range(3)]
    for _, t in rows[:20]:
        b = [ppm.START] * 5 + list(lower(t).encode()) + [ppm.END]
        for i in range(5, len(b)):
            for k in range(3):
                seen[k][int.from_bytes(bytes(b[i - k : i + 1]), "big")] += 1
    levels = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in seen]
    trie = ppm.Trie(levels)
    for ctx in (b"ab", b"a ", b"\xff\xff", b"zz", b"\xc3\xa9"):
        keys = np.array([int.from_bytes(ctx + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** trie.log10(keys)).sum() == pytest.approx(1.0, abs=1e-9)


def test_odd_rows_and_empty_table(docs_of, odd_rows):
    docs = docs_of([(*r, 1, True) for r in odd_rows], ", score int, held_out boolean")
    got = ppm.score(docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert ppm.score(docs_of([])).count() == 0
    alone = ppm.score(docs_of([(next(i for i in range(99) if held_out(i)), "ab", "en", "s", 0)])).first()
    assert alone.score == pytest.approx(-3 * math.log10(256)) and alone.n_known == 0 and alone.train_tokens == 0
