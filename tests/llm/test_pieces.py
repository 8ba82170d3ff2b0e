"""Byte-level BPE, spelling variants, source divergence, the word memory, and repaired cases of earlier operators."""
from __future__ import annotations

import hashlib
import random
import re
import struct
import time
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pitf.llm import bytebpe, divergence, html_extract, langid, packing, queries, spelling, topk
from pitf.llm.remembered import Remembered, flattened

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, ids STRING, word STRING, n LONG"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def frame(spark, rows):
    """(id, text, lang, source) rows beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], DOCS).repartition(3)


def odd_texts(seed=2, n=300):
    draw = random.Random(seed)
    pool = [*" \t\n\r\x0b\x1c\x1f\x85\xa0　''sStrveélmd019½²٣_-.,!ßÀÿ漢😀‍̀ ֋౜", "'ll", "  ", "<|endoftext|>"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(40))) for _ in range(n)]
    return [*texts, None, "", " ", "x" * 30_000, "ab " * 20_000, "same", "same"]


def test_byte_bpe_gives_the_ids_of_the_rank_file(spark):
    ranks = bytebpe.read_ranks(RANKS)
    asked = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i if i % 7 else None, t, "en", "a") for i, t in enumerate(odd_texts())]
    encoded = bytebpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    decoded = bytebpe.decode(encoded, RANKS).collect()

    def packed(text):
        ids = asked.encode_ordinary(text or "")
        return struct.pack(f"<{len(ids)}I", *ids)

    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in decoded) == Counter(
        (i, packed(t), (t or "").encode()) for i, t, *_ in rows)
    assert bytebpe.encode(frame(spark, rows).limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_pieces_that_merging_does_not_reach():
    """A pre-token that is an entry is that entry, though its parts merge otherwise."""
    entries = [bytes([b]) for b in range(256)] + [b"bc", b"abc"]  # a + bc joins; "ab" is no entry
    ranks = {x: i for i, x in enumerate([*entries, b"xyz"])}  # nothing leads to xyz
    coder = bytebpe.ByteBpe(ranks, public_tokenizers.PATTERN, {})
    ids, counts = coder.encode(["abc xyz", "xyz", "xyzx"])
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert np.split(ids, np.cumsum(counts)[:-1])[1].tolist() == [ranks[b"xyz"]]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want.encode_ordinary(x) for x in ("abc xyz", "xyz", "xyzx")]
    with pytest.raises(ValueError):
        bytebpe.model([b"a", b"b"])


def test_memory_forgets_within_its_bound_and_changes_nothing():
    asked = []

    def look_up(words):
        asked.append(len(words))
        return flattened([[len(w), *w] for w in words])

    memory = Remembered(look_up, limit=20_000)
    draw = random.Random(5)
    for _ in range(60):
        texts = [[bytes([draw.randrange(256)] * draw.randrange(1, 4)) for _ in range(draw.randrange(30))] for _ in range(9)]
        flat, counts = memory.encode(texts)
        want = [[x for w in words for x in (len(w), *w)] for words in texts]
        assert flat.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]
        assert memory.size <= 20_000 + 9 * 30 * 200
    assert len(asked) > 10


def test_packing_ids_are_the_tokenizers_at_any_memory():
    words = packing.WordTokenizer(queries.tokenizer_path())
    words.limit = 5_000
    for _ in range(3):
        texts = [t or "" for t in odd_texts(n=80)] + ["Hello, hello. HELLO., a.b, über, über."]
        got = words.ids(texts)
        assert [x.tolist() for x in got] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def brute_variants(rows, every, factor=10):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if every and h % every == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found, forms = {}, {}
    for w in counts:
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= factor * counts[w]:
            forms[w] = best
        found[w] = len(close)

    def root(w):
        return root(forms[w]) if w in forms else w

    return {w: (forms.get(w), root(w), counts[w], found[w], counts[forms[w]] if w in forms else None) for w in counts}


@pytest.mark.parametrize(("shard", "bound"), [(1 << 16, 32 << 20), (16, 100)])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, shard, bound):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    draw = random.Random(6)
    rows = []
    base = ["strasse" + x for x in ("nbahn", "Àÿ", "", "ssss", "nba")] + ["z" * 300]
    for i in range(150):
        words = []
        for _ in range(40):
            w = base[min(int(draw.random() ** 3 * 6), 5)]
            for _ in range(draw.choice([0] * 20 + [1, 2])):
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1:], w[:at] + draw.choice("abzé×") + w[at:], w[:at] + draw.choice("sta") + w[at + 1:]])
            words.append(draw.choice([w, w.upper(), w.title()]))
        rows.append((i if i % 9 else None, draw.choice([" ", "-", "Ā", "1"]).join(words), "en", "a"))
    rows += [(900, None, "en", "a"), (901, "", "en", "a"), (902, "q" * 70_000 + " " + "q" * 69_999, "en", "a"), (902, "q" * 70_000 + " " + "q" * 69_999, "en", "a")]
    words = spelling.count_words(frame(spark, rows), every=5)
    got = spelling.variants(words, broadcast_bytes=bound).collect()
    want = brute_variants(rows, 5)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want and len(got) == len(want)
    assert any(a != b[1] and b[0] != b[1] for a, b in want.items() if b[0]), "a chain of two forms"
    assert spelling.variants(words.limit(0)).collect() == []


def test_filters_hold_every_word_and_little_else():
    draw = np.random.default_rng(1)
    inside, outside = (draw.integers(0, 1 << 63, 20_000).astype(np.uint64) for _ in range(2))
    shards = spelling.Shards(1, {0: spelling.Shards.build(spelling.mix(inside))})
    assert len(shards.held(inside)) == len(inside) and len(shards.held(outside)) < 200


def test_divergence_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "TERMS", 3)
    monkeypatch.setattr(divergence, "CHUNK", 2)
    monkeypatch.setattr(divergence, "HELD_POSTINGS", 40)
    draw = random.Random(7)
    terms = ["a", "B", "b", "Été", "漢字。", "zz", "ÿĀ", *(f"w{chr(97 + i)}" for i in range(9))]
    rows = [(i, " ".join(draw.choice(terms) for _ in range(draw.randrange(12))), draw.choice(["en", "de", None]),
             draw.choice(["s1", "s2", "s3", "sé", "hot", "hot", "hot", None])) for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "xx", "lonely"), (1002, "rare words only", "yy", "p"), (1003, "", "yy", "q"), rows[0], rows[0]]
    docs = frame(spark, rows)
    got = divergence.audit(docs)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(queries.SQL["op13_source_divergence"]).fetchall()
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == sorted(want)
    assert ("yy", "p", "pair", "q", 0, 1) in want and any(r[2] == "term" for r in want)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_merging_equals_counting_at_once():
    draw = random.Random(8)
    runs, want, docs = [], defaultdict(Counter), Counter()
    for _ in range(7):
        block = divergence.Block()
        for _ in range(30):
            lang, source = draw.choice("xy"), draw.choice("abc")
            terms = [draw.choice("klmnopq") * draw.randrange(1, 3) for _ in range(draw.randrange(8))]
            block.add(lang, source, terms, 10)
            for t in terms:
                want[lang, t][source] += 1
            docs.update((lang, t) for t in set(terms))
        runs += block.runs(3)
    got = list(divergence.merged(iter(sorted(runs, key=lambda r: r[:3])), 4))
    assert {(lang, t): (n, dict(c)) for lang, t, n, c in got} == {k: (docs[k], dict(v)) for k, v in want.items() if docs[k] >= 4}
    assert len(got) == len({x[:2] for x in got})


@pytest.mark.parametrize("shard", [20_000, 40])
def test_every_row_is_a_candidate_also_with_repeated_ids(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "LEAF", 8)
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(draw.integers(0, 60, 150), draw.normal(0, 1, (150, 4)), strict=True)]
    rows += [(0, [1.0, 0.0, 0.0, 0.0])] * 30 + [(0, [0.0, 1.0, 0.0, 0.0]), (3, None), (5, [1.0, None, 0.0, 0.0]), (7, [float("nan")] * 4), (None, [1.0] * 4), (20, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>").withColumn("row", F.lit(1)).withColumn("shard", F.lit("x"))
    got = topk.top_k(table, F.col("vec_id") % 20 == 0).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.SQL["op4_top_k"]).fetchall())
    assert topk.top_k(table.limit(0), F.lit(True)).collect() == []


PARAGRAPH = "It was the first time that they had seen the river from this side of the hill, and all of them were silent for a while."


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><p>{}</p></body>", "<main class='no-header'><p>{}</p></main>", "<body class='menu'><p>{}</p></body>",
    "<article class='post has-comments'><p>{}</p></article>", "<div id='legal-news'><p>{}</p></div>", "<article class='comments'><p>{}</p></article>"])
def test_names_of_the_whole_page_condemn_nothing(page):
    assert html_extract.main_text(page.format(PARAGRAPH)) == PARAGRAPH


@pytest.mark.parametrize("name", ["comments", "cookie-notice", "post-comments", "side-bar", "site-footer", "legal-disclaimer", "ad"])
def test_names_of_other_parts_condemn(name):
    kept = f"<p>{PARAGRAPH} Here.</p>"
    assert html_extract.main_text(f"<div>{kept}</div><div class='{name}'><p>{PARAGRAPH}</p></div>") == f"{PARAGRAPH} Here."


def test_formulas_stay_and_open_declarations_take_linear_time():
    assert "x+1" in html_extract.main_text(f"<article><p>{PARAGRAPH} <math><mi>x</mi>+<mn>1</mn></math></p></article>")
    began = time.process_time()
    html_extract.main_text("<!" * 200_000)
    assert time.process_time() - began < 5


def test_any_number_of_languages(spark):
    draw = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:02d}": ["".join(draw.choice(letters) for _ in range(6)) for _ in range(12)] for i in range(70)}
    rows = [(10 * i + k, " ".join(draw.choice(words) for _ in range(60)), lang, "a") for i, (lang, words) in enumerate(own.items()) for k in range(3)]
    docs = frame(spark, rows)
    model = langid.fit(docs)
    assert model.names == sorted(own)
    got = {r["doc_id"]: r["_language"] for r in langid.identify(docs, model, F.col("text")).collect()}
    assert got == {i: lang for i, _, lang, _ in rows}


def test_digests_of_the_query(spark, tmp_path):
    rows = [(1, "Hello world's", "en", "a"), (2, None, "en", "a")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op11_byte_bpe(spark, str(tmp_path)).collect()}
    assert got[1]["decoded_sha256"] == hashlib.sha256(b"Hello world's").hexdigest()
    assert (got[2]["n_tokens"], got[2]["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())


def test_word_hashes_of_a_slice_take_bounded_memory():
    """Hashing a 4 MB slice of words holds a few times the text at most, and each word hashes as it does alone."""
    import tracemalloc

    import pyarrow as pa

    from pitf.llm.textcore import lowered, span_hashes, text_bytes, words
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choice("abcdeXYZé") for _ in range(draw.randint(1, 14)))
                      for _ in range(2000)) for _ in range(300)] + ["q" * 300_000 + " end"]
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    start, end, _ = words(data, offsets)
    low = lowered(data)
    tracemalloc.start()
    try:
        base = tracemalloc.get_traced_memory()[0]
        hashes = span_hashes(low, start, end)
        peak = tracemalloc.get_traced_memory()[1] - base
    finally:
        tracemalloc.stop()
    assert len(data) > 4_000_000 and peak < 10 * len(data) // 4 + (20 << 20)
    picked = sorted(draw.sample(range(len(start)), 200)) + [len(start) - 2, len(start) - 1]
    alone = [int(span_hashes(low, start[i:i + 1], end[i:i + 1])[0]) for i in picked]
    assert [int(hashes[i]) for i in picked] == alone
