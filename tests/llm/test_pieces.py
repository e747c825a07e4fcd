import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import pieces

PATH = pieces.model_path()
TEXTS = [
    "Hello  world\n x", " lead", "", "a", "tab\tb\x00\x7f", "日本語テスト 🎉", "  ", "a\r\n;\r\n", "x" * 700 + "ing" * 300, "The theretion whatever",
    "naïve café — “quotes” ✓", "▁x ▁▁ y", "\U0010ffff퟿",
]


def ids_of(texts, dropout, seed=1):
    packed = pieces.encode_texts(texts, np.arange(len(texts)).astype(np.uint64), PATH, dropout, seed)
    return [np.frombuffer(p, np.int32).tolist() for p in packed]


def test_without_dropout_the_library_agrees():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = [t for t in TEXTS if pieces.MARK not in t]
    assert ids_of(plain, 0.0) == sp.encode(plain)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_every_text_decodes_to_itself(dropout):
    for text, ids in zip(TEXTS, ids_of(TEXTS, dropout), strict=True):
        assert pieces.decode_ids(np.array(ids, np.int32), PATH) == text


def test_rounds_and_agenda_agree():
    model = pieces.pieces(PATH)
    words = sorted({w for t in TEXTS for w in model.words(" " + t) if len(w) > 1} | {" therefore", " internationalisation", "aaaaaaaa"})
    keys = np.arange(len(words)).astype(np.uint64) * np.uint64(7919)
    for dropout in (0.0, 0.2, 0.7):
        assert model.segment(words, keys, dropout) == [model.agenda(w, int(k), dropout) for w, k in zip(words, keys, strict=True)]


def test_dropout_varies_and_repeats():
    text = "the whatever therefore " * 200
    a, b, c = ids_of([text], 0.1), ids_of([text], 0.1), ids_of([text], 0.1, seed=2)
    assert a == b != c
    assert len(a[0]) > len(ids_of([text], 0.0)[0])
    assert len(ids_of(["therefore"], 1.0)[0]) == len(" therefore")


def test_share_of_skipped_merges():
    keys = np.random.default_rng(0).integers(0, 2**63, 100_000).astype(np.uint64)
    assert abs(pieces.skipped(keys, 1, 2, 3, 0.1).mean() - 0.1) < 0.005


def test_every_occurrence_is_segmented_on_its_own(docs_of):
    rows = [(i, " ".join(["a"] * 500), "en", "s", 0) for i in range(60)] + [(100 + i, "therefore", "en", "s", 0) for i in range(400)]
    got = {r.doc_id: r.ids for r in pieces.encode(docs_of(rows), dropout=0.1).collect()}
    # the blank and the letter are the one merge of this word: a skipped one gives two ids
    rate = sum(len(got[i]) for i in range(60)) / (60 * 500) - 1
    assert abs(rate - 0.1) < 0.01
    assert len({tuple(got[100 + i]) for i in range(400)}) > 20


def test_frames(docs_of, odd_rows):
    docs = docs_of([(*r, 1, "x") for r in odd_rows], ", ids int, decoded string")
    out = pieces.decode(pieces.encode(docs, check=True))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "lossless", "decoded"]
    assert out.filter(~F.col("lossless")).count() == 0
    assert out.filter(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert out.filter("text is null").select(F.size("ids")).first()[0] == 0
    assert pieces.encode(docs_of([])).count() == 0
    twice = pieces.encode(docs.repartition(5)).filter("doc_id = 4").select("ids").distinct()
    assert twice.count() == 1
