import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import graph, near_dedup
from tabwright.llm import weighted_minhash as M
from tabwright.llm.base import strings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def multiset(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    same = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - same
    return same / whole if whole else 1.0


def brute(rows):
    sets = {i: multiset(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and similarity(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def family(rng, n, edits, length=120):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(docs_of):
    rng = random.Random(1)
    texts = [t for k in range(12) for t in family(rng, 5, 1 + k % 3)]
    texts += [texts[0], texts[0].upper(), "", None, " ", "two words", "Two  words", "a a a a a a a a a", "a a a a a a a a a a"]
    rows = list(enumerate(texts))
    got = near_dedup.classes(docs_of([(i, t, "en", "s", 0) for i, t in rows])).collect()
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)


@pytest.mark.parametrize("few", [0, 10**6])
def test_large_group_of_chained_copies(docs_of, monkeypatch, few):
    """Neighbours are close, ends are far apart; tiles are smaller than the group."""
    monkeypatch.setattr(near_dedup, "TILE", 8)
    monkeypatch.setattr(near_dedup, "FEW", few)
    rng = random.Random(2)
    w = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w), "en", "s", 0))
        w[rng.randrange(300)] = f"n{i}"
    got = near_dedup.classes(docs_of(rows)).collect()
    want = brute([r[:2] for r in rows])
    assert {r.doc_id: r.class_id for r in got} == want


def test_signatures_estimate_weighted_jaccard():
    rng, errors = random.Random(3), []
    for _ in range(40):
        a = [f"w{rng.randrange(40)}" for _ in range(60)]
        b = a[: rng.randrange(20, 60)] * rng.choice((1, 1, 2))
        x, y = Counter(a), Counter(b)
        j = sum((x & y).values()) / sum((x | y).values())
        h, rows = M.shingles(*strings(_array([" ".join(a), " ".join(b)])), words=1)
        s = M.signatures(h, rows, 2, 1000)
        errors.append(float((s[0] == s[1]).mean()) - j)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.025


def _array(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_signature_does_not_depend_on_neighbours():
    data = strings(_array(["a b c d e f g", "", "x y z", "a b c d e f g"]))
    h, rows = M.shingles(*data)
    s = M.signatures(h, rows, 4, 60)
    alone, r = M.shingles(*strings(_array(["a b c d e f g"])))
    assert (s[0] == s[3]).all()
    assert (s[0] == M.signatures(alone, r, 1, 60)[0]).all()
    assert not s[1].any()


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    got = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for start in sorted(near):
        if start in want or near[start] == {start}:
            continue
        todo = [start]
        while todo:
            n = todo.pop()
            if n not in want:
                want[n] = start
                todo += near[n]
    assert {r.node: r.root for r in got.collect()} == want


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of([(*r, 1, 2) for r in odd_rows], ", node int, class_id int")
    got = near_dedup.classes(docs).collect()
    assert len(got) == len(odd_rows)
    of = {r.doc_id: r for r in got}
    assert {of[i].class_id for i in (1, 2, 3)} == {1}
    assert of[4].class_id == -(2**63) and of[4].class_size == 4  # the null id is the least
    left = near_dedup.survivors(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in left.collect()) == [(False, 0), (True, 1), (True, 6), (True, 7), (True, 8)]


def test_null_and_shared_ids_are_told_apart_by_text(docs_of):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(60)) for k in "abcde")
    rows = [(None, a), (None, b), (None, b), (None, a + " end"), (3, c), (5, c), (5, d), (6, d), (7, e), (7, a + " more"), (8, e)]
    docs = docs_of([(i, t, "en", "s", 0) for i, t in rows])
    left = sorted((r.doc_id is not None, r.doc_id or 0, r.text.split()[0]) for r in near_dedup.survivors(docs).collect())
    firsts = {k: t.split()[0] for k, t in zip("abcde", (a, b, c, d, e), strict=True)}
    assert left == sorted([(False, 0, firsts["a"]), (False, 0, firsts["b"]), (True, 3, firsts["c"]), (True, 5, firsts["d"]), (True, 7, firsts["e"])])
    got = near_dedup.classes(docs).filter(F.col("doc_id") == -(2**63)).collect()
    assert sorted((r.class_size, r.kept) for r in got if r.kept) in ([(2, True), (2, True), (3, True)], [(2, True), (2, True), (3, True), (3, True)])
    assert len({r.class_id for r in got}) == 2


def test_empty_table(docs_of):
    assert near_dedup.classes(docs_of([])).count() == 0


def test_word_hashes_do_not_depend_on_runs(monkeypatch):
    from tabwright.llm import base

    rng = np.random.default_rng(4)
    text = " ".join("x" * int(n) + "yz"[int(n) % 2] for n in rng.integers(0, 60, 300)).encode()
    data = np.frombuffer(text, np.uint8)
    starts, _ = base.word_starts(data, np.array([0, len(data)]))
    want = base.word_hashes(data, starts)
    by_word = dict(zip(text.split(), want.tolist(), strict=False))
    assert [by_word[w] for w in text.split()] == want.tolist() and len(set(by_word.values())) == len(by_word)
    for run in (16, 50, 1000):
        monkeypatch.setattr(base, "_RUN", run)
        monkeypatch.setattr(base, "_POWERS", {})
        assert base.word_hashes(data, starts).tolist() == want.tolist()


def test_tiles_go_by_whole_band_keys(spark):
    """Two nodes whose short signatures agree everywhere, but whose only common band is the last: they meet there, once."""
    import numpy as np

    from tabwright.llm import near_dedup as N

    keys = np.arange(3 * N.BANDS).reshape(3, N.BANDS)
    keys[:, -1] = 999
    sig = bytes(N.BANDS * N.ROWS)
    sigs = spark.createDataFrame([(i, bytearray(sig), bytearray(keys[i].astype(np.int64).tobytes())) for i in range(3)], "node bigint, sig binary, bands binary")
    members = spark.createDataFrame([(999, i, i, 3) for i in range(3)], "key bigint, node bigint, root bigint, n bigint")
    got = sorted(tuple(r) for r in N._tiles(members, sigs).collect())
    assert got == [(0, 1), (0, 2), (1, 2)]
