"""Pieces of the operators against plain versions, evidence of a language, empty tables and clashing names."""
from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitf.llm import fingerprint, html_extract, langid, mixing, quality, topk, toxicity


def filled(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Targets by raising one level for all until the words are shared out."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    low, high, words = 0.0, 1e9, share * sum(sizes.values())
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(most * sizes[s], level * weight[s]) for s in sizes) < words:
            low = level
        else:
            high = level
    return {s: min(most * sizes[s], high * weight[s]) for s in sizes}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_targets_equal_a_level_found_by_bisection(spark, seed):
    draw = random.Random(seed)
    names = [None, "", "é", "Z", *(f"s{i}" for i in range(draw.choice([0, 1, 7, 40])))]
    sizes = {s: draw.choice([0, 1, 30, 1000, 40_000]) for s in names} | {"Z": 500}
    rows = [(s, part) for s, n in sizes.items() for part in (n // 3, n - n // 3)]
    got = mixing.source_targets(spark.createDataFrame(rows, "source STRING, size LONG")).collect()
    assert {r["source"]: r["source_size"] for r in got} == sizes
    assert {r["source"]: r["target"] for r in got} == pytest.approx(filled(sizes), rel=1e-9, abs=1e-6)


def test_one_source_and_sources_without_words(spark):
    for rows, expected in (([("a", 10)], {"a": 15.0}), ([("a", 0), (None, 0)], {"a": 0.0, None: 0.0})):
        got = mixing.source_targets(spark.createDataFrame(rows, "source STRING, size LONG")).collect()
        assert {r["source"]: r["target"] for r in got} == pytest.approx(expected)


def table_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance_equals_the_table():
    draw = random.Random(8)
    for _ in range(400):
        letters = "ab" if draw.random() < .5 else fingerprint.ALPHABET
        a, b = ("".join(draw.choices(letters, k=draw.randint(0, 70))) for _ in range(2))
        if draw.random() < .5 and a:
            at = draw.randrange(len(a))
            b = a[:at] + draw.choice(["", "x", "yz"]) + a[at + draw.randint(0, 3):]
        assert fingerprint.edit_distance(a, b) == fingerprint.edit_distance(b, a) == table_distance(a, b)


def chunk_ends(data: bytes, block: int) -> list[int]:
    """Where chunks end, byte by byte."""
    ends = []
    for i in range(len(data)):
        rolled = sum(data[i - back] * pow(0x01000193, back, 1 << 32) for back in range(min(fingerprint.WINDOW, i + 1))) % (1 << 32)
        rolled ^= rolled >> 15
        rolled = rolled * 0x2C1B3C6D % (1 << 32)
        if (rolled ^ rolled >> 12) % block == block - 1:
            ends.append(i + 1)
    return ends + [len(data)] * (not ends or ends[-1] < len(data)) if data else []


def test_signatures_have_a_letter_for_each_chunk_that_depends_on_it_alone():
    draw = random.Random(4)
    for n in (0, 1, 6, 7, 8, 500, 6000):
        data = bytes(draw.choices(b"abcdefgh \xc3\xa9", k=n))
        block, first, second = fingerprint.fingerprint(data).split(":")
        letters: dict[bytes, str] = {}
        for size, sign in ((int(block), first), (2 * int(block), second)):
            ends = chunk_ends(data, size)
            assert len(sign) == len(ends)
            for start, end, letter in zip([0, *ends], ends, sign, strict=False):
                assert letters.setdefault(data[start:end], letter) == letter
    assert fingerprint.likeness("3:ABCDEFGHIJ:ABCDE", "48:ABCDEFGHIJ:ABCDE") == 0.0
    assert fingerprint.likeness("6:ABCDEFGHIJ:x", "3:y:ABCDEFGHIK") == pytest.approx(0.9)


def test_declared_language_decides_what_the_text_leaves_open(spark):
    # Words both languages share equally tell nothing; what pages of a declaration turned out to be does.
    english, german = "the cat and the dog are here with you", "der hund und die katze sind hier mit dir"
    rows = [(i, t, lang, declared) for i, (t, lang, declared) in enumerate(
        [(english, "en", "en")] * 30 + [(german, "de", "de")] * 30 + [("hand land sand", "en", None), ("hand land sand", "de", None)])]
    docs = spark.createDataFrame([*rows, (100, "hand land", None, "de"), (101, "hand land", None, "en"), (102, "hand land", None, "never seen"),
                                  (103, english, None, "de"), (104, None, None, "de")], "doc_id INT, text STRING, lang STRING, declared STRING")
    found = {r["doc_id"]: r for r in langid.identify(docs, langid.fit(docs), F.col("text"), F.col("declared")).collect()}
    assert (found[100]["_language"], found[101]["_language"]) == ("de", "en")
    # Without evidence the text leans to one of them: agreeing with it makes that surer, the other declaration overturns it.
    assert found[102]["_language"] == "en" and found[101]["_probability"] > found[102]["_probability"]
    assert found[103]["_language"] == "en" and found[104]["_language"] == "und" and not found[104]["_accepted"]


def test_language_of_markup_and_host_of_an_address(spark):
    pages = {"<html lang=en-GB>": "en", "<!doctype html><HTML class='x' LANG = 'de'>": "de", "<html><p lang='fr'>": None, "lang='es'": None,
             "": None, None: None}
    got = spark.createDataFrame([(p,) for p in pages], "p STRING").select("p", langid.markup_language(F.col("p")).alias("x")).collect()
    assert {r["p"]: r["x"] for r in got} == pages
    urls = {"https://Example.ORG:8080/a?b#c": ("example.org", "org"), "http://user:pw@a.b.de": ("a.b.de", "de"), "ftp://localhost/x": ("localhost", None),
            "no address": (None, None), "": (None, None), None: (None, None)}
    host = langid.address_host(F.col("u"))
    got = spark.createDataFrame([(u,) for u in urls], "u STRING").select("u", host.alias("h"), langid.address_suffix(host).alias("s")).collect()
    assert {r["u"]: (r["h"], r["s"]) for r in got} == urls


def test_empty_pages_and_classifiers(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id LONG, html STRING")).isEmpty()
    none = spark.createDataFrame([], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    for module in (quality, toxicity):
        assert module.score(none, module.train(none, labels)).isEmpty()
    for label in (0, 1):  # one class only
        docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id LONG, text STRING")
        marked = spark.createDataFrame([(1, label, label)], "doc_id LONG, quality INT, toxic INT")
        for module in (quality, toxicity):
            scores = [r["_score"] for r in module.score(docs, module.train(docs, marked)).collect()]
            assert len(scores) == 2 and all(0 <= s <= 1 for s in scores)


def test_columns_of_the_results_names_do_not_disturb(spark):
    page = "<p>The first of the words is what the reader came for, and it is as long as a paragraph of an article has to be.</p>"
    pages = spark.createDataFrame([(1, page, "old", 5, "u"), (1, page, "old", 5, "u"), (2, None, None, None, None), (None, "", "x", 1, "u")],
                                  "page_id LONG, html STRING, _text STRING, _chars LONG, url STRING")
    out = html_extract.extract(pages)
    assert sorted(out.columns) == ["_chars", "_text", "html", "page_id", "url"]
    rows = out.collect()
    assert sorted(r["_chars"] for r in rows) == [0, 0, len(page) - 7, len(page) - 7]
    assert all(r["_chars"] == len(r["_text"]) and r["_text"] != "old" for r in rows)

    docs = spark.createDataFrame([(i, t, lang, "xx", 9.0, True) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 9)],
                                 "doc_id INT, text STRING, lang STRING, _language STRING, _probability DOUBLE, _accepted BOOLEAN")
    found = langid.identify(docs, langid.fit(docs), F.col("text"))
    assert sorted(found.columns) == sorted(docs.columns) and all(r["_language"] == r["lang"] for r in found.collect())

    rows = np.random.default_rng(2).normal(size=(30, 4))
    plain = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    clashing = plain.withColumns({n: F.lit(0) for n in ("query_id", "rank", "score", "_query", "shard", "row", "block")})
    query = F.col("vec_id") % 10 == 0
    assert sorted(map(tuple, topk.top_k(clashing, query, 5).collect())) == sorted(map(tuple, topk.top_k(plain, query, 5).collect()))
