import math
import random

import pytest

from tabwright.llm import language

WORDS = {"en": ["the", "house", "with", "water", "and", "which"], "de": ["der", "haus", "nicht", "wasser", "und", "über"], "fr": ["le", "maison", "avec", "eau", "où", "très"]}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(60)), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    return spark.createDataFrame([*rows, (99, "x", None), (100, None, "en")], "doc_id bigint, text string, lang string")


def page(lang, text, declared=None):
    head = f'<html lang="{declared}">' if declared else "<html>"
    return f"<!DOCTYPE html>{head}<script>var the = 1;</script><body><p>{text}</p><!-- the the --></body></html>"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, lang string, host string")


def test_text_and_other_evidence(spark, docs):
    rng = random.Random(2)
    rows, truth = [], {}
    for i in range(120):
        lang = ["en", "de", "fr"][i % 3]
        truth[i] = lang
        rows.append((i, f"https://a.site{i % 3}.{lang if lang != 'en' else 'com'}/x", page(lang, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang), "zz", "h"))
    # no text: the markup decides; no markup either: the host does
    rows += [(200, "https://b.other.org/", page("de", "", "de"), None, None), (201, "https://a.site2.fr/empty", page("fr", ""), None, None)]
    # a wrong declaration does not outweigh a clear text
    rows += [(202, "https://c.other.org/", page("de", " ".join(WORDS["de"] * 10), "fr"), None, None)]
    got = {r.page_id: r for r in language.identify(pages_of(spark, rows), docs).collect()}
    assert {i: got[i].lang for i in truth} == truth
    assert got[200].lang == "de" and got[201].lang == "fr" and got[202].lang == "de"
    assert got[201].text_lang is None and got[201].n_trigrams == 0
    for r in got.values():
        assert math.isclose(sum(r.posterior), 1.0, abs_tol=1e-9)
        assert r.probability == max(r.posterior)


def test_odd_pages(spark, docs):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "", None, None), (3, "not an address", "<html lang=", None, None), (4, "http://x.fr", "<p>" + "le maison " * 30_000, None, None)]
    got = language.identify(pages_of(spark, rows), docs).collect()
    assert len(got) == 5
    by = {r.page_id: r for r in got}
    assert by[1].host == "" and by[1].declared is None and by[4].lang == "fr" and by[4].suffix == "fr"


def test_empty_tables(spark, docs):
    assert language.identify(pages_of(spark, []), docs).count() == 0
    none = language.identify(pages_of(spark, [(1, "http://a.de/", page("de", "haus", "de"), None, None)]), docs.filter("false"))
    assert [(r.page_id, r.lang, r.host) for r in none.collect()] == [(1, None, "a.de")]


def test_markup():
    assert language.declared('<HTML class=x LANG=EN-us>') == "en"
    assert language.declared('<meta http-equiv="content-language" content="de-AT">') == "de"
    assert language.declared("<html><p lang='fr'>") is None
    assert language.visible("<p>a&amp;b<style>p{}</style><br>c</p>").split() == ["a&b", "c"]
