import re
from collections import defaultdict

from pyspark.sql import functions as F

from tabwright.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for g in groups.values():
        keep = min(g, key=lambda r: (-len(r[1]), r[0]))[0]
        out += [(i, keep, len(g)) for i, _ in g]
    return sorted(out)


def test_equals_brute_force(docs_of):
    rows = [(i, ["a b", "ab", "a\tb ", "c", None, "", " "][i % 7], "en", "s", 0) for i in range(60)]
    got = exact_dedup.dedup(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute([r[:2] for r in rows])
    assert sum(r.kept for r in got) == 3
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_bytes_decide_when_digests_clash(docs_of):
    rows = [(i, f"text {i % 5}", "en", "s", 0) for i in range(30)]
    got = exact_dedup.dedup(docs_of(rows), digest=lambda norm: F.substring(norm, 1, 2).cast("binary")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute([r[:2] for r in rows])


def test_state_goes_on(docs_of, tmp_path):
    folder = str(tmp_path / "seen")
    first = exact_dedup.dedup(docs_of([(5, "a b", "en", "s", 0), (6, "c", "en", "s", 0)]), folder=folder)
    assert {(r.doc_id, r.keep_id) for r in first.collect()} == {(5, 5), (6, 6)}
    both = exact_dedup.dedup(docs_of([(3, "ab", "en", "s", 0), (2, "a  b", "en", "s", 0)]), folder=folder, resume=True)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in both.collect()} == {(5, 2, 3), (3, 2, 3), (2, 2, 3), (6, 6, 1)}


def test_bytes_of_earlier_calls_are_compared(docs_of, tmp_path):
    """A digest of one byte: "ab" of the first call and "ac" of the second share it, yet are two texts."""
    folder = str(tmp_path / "seen")
    digest = lambda norm: F.substring(norm, 1, 1).cast("binary")
    exact_dedup.dedup(docs_of([(1, "ab", "en", "s", 0)]), digest, folder)
    got = exact_dedup.dedup(docs_of([(2, "ac", "en", "s", 0), (3, "a b", "en", "s", 0)]), digest, folder, resume=True).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]


def test_odd_rows(docs_of, odd_rows):
    rows = [(*r, "x", 1) for r in odd_rows]
    docs = docs_of(rows, ", digest string, kept int")
    got = exact_dedup.dedup(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == 5  # empty, the six words, and three others
    assert {r.group_size for r in got if r.doc_id in (1, 2, 3)} == {3}
    left = exact_dedup.survivors(docs)
    assert left.columns == docs.columns
    # of the empty ones the longest stays, of the six words the row with the two blanks
    assert sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7, 8]


def test_empty_table(docs_of):
    assert exact_dedup.dedup(docs_of([])).count() == 0
    assert exact_dedup.survivors(docs_of([])).count() == 0
