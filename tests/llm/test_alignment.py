import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabwright.llm import alignment as A

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{A.TOKENIZERS}/{A.BYTE_VOCABULARY}")
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=f"{A.TOKENIZERS}/{A.PIECE_MODEL}")
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    code = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}

    def both(text):
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = s.encode(text)
        wa = [bytes(code[c] for c in t.id_to_token(i)) for i in a]
        wb = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in b]
        return a, b, wa, wb

    return both


def brute(coders, rows):
    found = []
    for doc_id, text in rows:
        groups = []
        if text:
            a, b, wa, wb = coders(text)
            if b"".join(wa) == b"".join(wb) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(w) for w in wa]).tolist(), np.cumsum([len(w) for w in wb]).tolist()
                ends = sorted(set(ends_a) & set(ends_b))
                number = {end: k for k, end in enumerate(ends)}
                groups = [([], []) for _ in ends]
                for side, ids, own in ((0, a, ends_a), (1, b, ends_b)):
                    k = 0
                    for i, end in zip(ids, own, strict=True):
                        groups[k][side].append(i)
                        k = number[end] + 1 if end in number else k
        found.append((doc_id, groups))
    count = Counter()
    for _, groups in found:
        count.update({(x, y) for g, h in groups for x in set(g) for y in set(h)})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, groups in found:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_a, n_b = sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha))
    return out, count


def got(spark, rows, schema="doc_id bigint, text string"):
    found = A.align(spark.createDataFrame(rows, schema))
    out = A.scored(found)
    assert out.columns == COLUMNS
    return [tuple(r) for r in out.collect()], {(r.a, r.b): r.n for r in found.pair_counts().collect()}


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def made(seed, n):
    rng = random.Random(seed)
    bits = ["the", " house", "über", "strasse", " 12", "345", "\n", "  ", "!", "é", "日本", "🎉", "tion", "ing", "A", "<|endoftext|>", "</s>", "<0x41>", "▁", "\t", "ſ", "xx", "xxxxx", "'s"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 60)))) for i in range(n)]


def test_against_brute_force(spark, coders):
    rows = made(1, 400)
    want, counts = brute(coders, rows)
    found, pairs = got(spark, rows)
    assert order(found) == order(want)
    assert pairs == dict(counts)
    assert any(r[1] for r in want) and any(x != y for x, y in pairs)


def test_given_table(spark, coders):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    want, _ = brute(coders, [(i, t) for i, t in rows if len(t or "") < 5000])
    small = {r[0]: r for r in want}
    found = {r.doc_id: tuple(r) for r in A.scored(A.align(df)).collect()}
    assert len(found) == len(rows)
    # what does not depend on the long texts
    assert all(found[i][:5] + found[i][7:] == small[i][:5] + small[i][7:] for i in small)


def test_odd_rows(spark, coders, odd_rows):
    rows = [r[:2] for r in odd_rows] + [(None, "x"), (None, "x"), (9, "▁ a"), (10, "ab" * 3), (11, "\x00\x01 \x85"), (12, "　wide ﬁ")]
    want, counts = brute(coders, [(i, t) for i, t in rows if len(t or "") < 250_000])
    extra = [(*r, "c", 1, "p") for r in rows if len(r[1] or "") < 250_000]
    found, pairs = got(spark, extra, "doc_id bigint, text string, chunk string, n int, pair string")
    assert order(found) == order(want) and pairs == dict(counts)
    zero = [r for r in found if not r[1]]
    assert {r[2:] for r in zero} == {(0, 0, 0, 0, 0, "")} and {1, 2} <= {r[0] for r in zero}
    # one text without common ends: its ids meet, its tokens do not
    found, _ = got(spark, rows)
    assert len(found) == len(rows)
    assert got(spark, []) == ([], {})


def test_blocks_of_ids(monkeypatch, spark, coders):
    rng = np.random.default_rng(0)
    ids_a, ids_b = rng.integers(0, 50, 300), rng.integers(0, 50, 200)
    la, lb = np.full(300, 4), np.full(200, 6)
    g = A.grouped(ids_a, ids_b, la, lb, np.array([600, 600]))
    same = np.arange(60)
    results = []
    for block in (1, 7, 1 << 22):
        monkeypatch.setattr(A, "BLOCK", block)
        exact, other, per_group = A.links(g, same, np.array([5, 9]))
        counts = Counter({("=", d, a): n for d, a, n in zip(*map(np.ndarray.tolist, exact), strict=True)})
        counts.update({(d, p // A.SPAN, p % A.SPAN): n for d, p, n in zip(*map(np.ndarray.tolist, other), strict=True)})
        results.append(counts)
    want = Counter()
    for x, gx in zip(ids_a.tolist(), g.ga.tolist(), strict=True):
        for y, gy in zip(ids_b.tolist(), g.gb.tolist(), strict=True):
            if gx == gy:
                d = [5, 9][g.doc[gx]]
                want[("=", d, x) if x == y else (d, x, y)] += 1
    assert results[0] == results[1] == results[2] == want
    assert per_group.sum() == sum(want.values())


def test_engine_encodes_as_the_vocabulary_file(coders):
    """The byte-level side against the library that the file is made for, one code point after another."""
    side = A.byte_level(A.TOKENIZERS)
    rng = random.Random(2)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + rng.sample(range(0x3000, 0xD800), 1500) + rng.sample(range(0xE000, 0x20000), 1500)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} {chr(c)}1 .{chr(c)}.  {chr(c)}  {chr(c)}\n'{chr(c)}s" for c in points]
    assert side.encode(texts) == [coders(t)[0] for t in texts]


def test_packed_numbers():
    for arrays in ([], [[]], [[0]], [[3, 255], [], [256, 0, 1], [65_536], [2**32, 7], [2**62]]):
        back = A._unpacked(A._packed([np.array(v, np.int64) for v in arrays]))
        assert [v.tolist() for v in back] == arrays and all(v.dtype == np.int64 for v in back)


def test_chunks_are_smaller_than_their_texts(spark):
    """What an executor holds of a chunk, to read, deal and pass it on, stays below the bytes of its texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvwyzäöüß") for _ in range(rng.randrange(2, 12))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(500))) for i in range(150)]
    found = A.align(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))
    assert found.chunks.count() > 1
    assert found.chunks.toArrow().nbytes < sum(len(t.encode()) for _, t in rows)


def test_many_chunks_in_files_of_few(spark, coders, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_BYTES", 300)
    monkeypatch.setattr(A, "FILE_CHUNKS", 4)
    rows = [*made(6, 300), (None, ""), (None, None), (7, "x" * 2000)]
    want, counts = brute(coders, rows)
    found = A.align(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, "5")  # the pairs of a chunk come in several batches
    try:
        assert order([tuple(r) for r in A.scored(found).collect()]) == order(want)
    finally:
        spark.conf.unset(batch)
    assert {(r.a, r.b): r.n for r in found.pair_counts().collect()} == dict(counts)
    per_file = [r["count"] for r in found.chunks.groupBy("_metadata.file_path").count().collect()]
    assert sum(per_file) > 20 and max(per_file) <= 4
