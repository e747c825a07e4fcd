from collections import Counter

import numpy as np
import pytest

from tabwright.llm import shards


@pytest.mark.parametrize("n, k", [(1000, 24), (5, 24), (96, 3), (1, 1)])
def test_sizes_and_slots(docs_of, monkeypatch, n, k):
    monkeypatch.setattr(shards, "STRETCH_ROWS", 10)
    docs = docs_of([(i, f"t{i}", "en", "s", i) for i in range(n)])
    got = shards.shuffle(docs, k, part_rows=100).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes[s] for s in range(k)) == sorted(n // k + (s < n % k) for s in range(k))
    for s in range(k):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_layout_does_not_matter(docs_of):
    docs = docs_of([(i, f"t{i}", "en", "s", i) for i in range(300)])
    a, b = (sorted((r.doc_id, r.shard, r.slot) for r in shards.shuffle(d, 7, part_rows=40).collect()) for d in (docs.coalesce(1), docs.repartition(6)))
    assert a == b
    c = sorted((r.doc_id, r.shard, r.slot) for r in shards.shuffle(docs, 7, seed=2, part_rows=40).collect())
    assert a != c


def test_repeated_ids_keep_sizes_exact(docs_of):
    rows = [(1, "same", "en", "s", 0)] * 70 + [(None, None, None, None, None)] * 20 + [(2, f"t{i}", "en", "s", i) for i in range(30)]
    got = shards.shuffle(docs_of([(*r, 9, 9) for r in rows], ", shard int, slot int"), 9, part_rows=16).collect()
    assert len(got) == 120
    assert sorted(Counter(r.shard for r in got).values()) == [13] * 6 + [14] * 3
    for s in range(9):
        mine = [r.slot for r in got if r.shard == s]
        assert sorted(mine) == list(range(len(mine)))


def test_empty_table(docs_of):
    assert shards.shuffle(docs_of([])).count() == 0


@pytest.mark.parametrize("good, bad, draws", [(30, 70, 20), (5, 3, 4), (1000, 10, 500), (400_000_000, 600_000_000, 10_000)])
def test_hypergeometric_moments(good, bad, draws):
    rng = np.random.default_rng(3)
    x = np.array([shards.hypergeometric(rng, good, bad, draws) for _ in range(4000)])
    n = good + bad
    mean = draws * good / n
    var = mean * bad / n * (n - draws) / (n - 1)
    assert abs(x.mean() - mean) < 5 * np.sqrt(var / 4000) + 1e-9
    assert var * 0.85 < x.var() < var * 1.15
    assert x.min() >= max(0, draws - bad) and x.max() <= min(good, draws)


def test_hypergeometric_beyond_a_billion_rows():
    rng = np.random.default_rng(1)
    x = [shards.hypergeometric(rng, 2 * 10**9, 48 * 10**9, 50_000) for _ in range(50)]
    assert abs(np.mean(x) - 2000) < 40


def test_matrix_margins():
    rows, columns = [7, 0, 13, 100], [40, 40, 39, 1]
    m = shards.matrix(rows, columns, 1)
    assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == columns


def test_every_row_may_go_anywhere(docs_of):
    docs = docs_of([(i, "t", "en", "s", i) for i in range(12)]).cache()
    seen = Counter()
    for seed in range(25):
        for r in shards.shuffle(docs, 3, seed=seed, part_rows=5).collect():
            seen[r.doc_id, r.shard] += 1
    counts = np.array([seen[i, s] for i in range(12) for s in range(3)])
    assert counts.sum() == 300 and (((counts - 25 / 3) ** 2) / (25 / 3)).sum() < 60
