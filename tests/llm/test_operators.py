"""Operators against brute force and on awkward input: nulls, empty tables, repeats, clashing names."""
from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitf.llm import fingerprint, html_extract, katz, langid, mixing, ngram_join, packing, quality, topk, toxicity
from pitf.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _score INT, pool STRING"


def frame(spark, texts, sources=("a", "b", None)):
    return spark.createDataFrame(
        [(i, t, "en", sources[(i or 0) % len(sources)], len(t or ""), 1, "x") for i, t in texts], DOCS).repartition(3)


def awkward(seed=3, n=60):
    draw = random.Random(seed)
    words = [a + b for a, b in itertools.product("bcdfg", "aeiou")]
    base = " ".join(draw.choice(words) for _ in range(60))
    texts = []
    for _ in range(n):
        w = base.split() if draw.random() < .6 else [draw.choice(words) for _ in range(draw.randint(1, 80))]
        for _ in range(draw.randint(0, 3)):
            w[draw.randrange(len(w))] = draw.choice(words)
        texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, " \t\n"), (103, "One two"), (104, "one TWO"), (105, texts[0])]
    return [*rows, (None, texts[1]), (106, "very " * 5000)]


@pytest.mark.parametrize("width,percent,block", [(4, 85, 1024), (5, 80, 3), (1, 60, 2), (2, 50, 5)])
def test_links_equal_brute_force(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(ngram_join, "POOL_BLOCK", block)
    rows = awkward()
    found = {r["doc_id"]: r for r in ngram_join.link_components(frame(spark, rows), width=width, percent=percent).collect()}
    sets, top = {}, {i: i for i, _ in rows if i is not None}
    for i, text in rows:
        w = WORD.findall((text or "").lower())
        sets[i] = {tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()

    def root(i):
        return i if top[i] == i else root(top[i])

    for a, b in itertools.combinations(sorted(top), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items() if i is not None} == {
        i: (len(sets[i]), root(i)) for i in top}
    assert found[None]["component_id"] is None


def test_mix_meets_targets(spark):
    rows = awkward(n=200) + [(7, "same row"), (7, "same row")]
    plan = mixing.copies(frame(spark, rows)).toPandas()
    assert plan.rows.sum() == len(rows)
    assert (plan.taken <= 2 * plan.rows).all()
    words = plan["size"] * plan.taken / 1
    for source, part in plan.assign(words=words).groupby("source", dropna=False):
        assert abs(part.words.sum() - part.target.iloc[0]) <= part["size"].max()
        assert part.target.iloc[0] <= 2 * part.source_size.iloc[0] + 1e-6
    totals = plan.drop_duplicates("source")
    assert totals.target.sum() == pytest.approx(1.5 * totals.source_size.sum())
    again = mixing.copies(frame(spark, rows).repartition(5)).toPandas()
    keys = ["id", "source", "size"]
    assert plan.sort_values(keys).taken.tolist() == again.sort_values(keys).taken.tolist()
    mixed = mixing.mix(frame(spark, rows))
    assert mixed.columns == frame(spark, rows).columns and mixed.count() == plan.taken.sum()


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    rows = [*awkward(), (200, "<|endoftext|> Was <|ENDOFTEXT|>,. it's 12,5. \x1cx ÀÉ. a\x85b")]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack(frame(spark, rows), tokenizer_path(), size=256).toPandas()
    for i, text in rows:
        own = pieces[pieces.doc_id.isna() if i is None else pieces.doc_id == i].sort_values("start")
        ids = np.concatenate([np.frombuffer(x, "<u4") for x in own.ids])
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    length = pieces.ids.str.len() // 4
    for _, part in pieces.assign(length=length).groupby("sequence_id"):
        part = part.sort_values("offset")
        assert (part.offset == part.length.cumsum() - part.length).all() and part.length.sum() <= 256
    fill = length.groupby(pieces.sequence_id).sum()
    assert sum(256 - x for x in fill if x & (x - 1)) == 0


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(1)
    vectors = [draw.normal(size=8).tolist() for _ in range(400)] + [[.5] * 8] * 300
    rows = list(enumerate(vectors)) + [(1000, None), (1001, [float("nan")] * 8), (1002, [None] * 8), (None, [1.0] * 8), (1003, [1.0])]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, k=7).toPandas()
    whole = np.floor(64 * np.array(vectors)).astype(int)
    for q in range(0, len(vectors), 20):
        scores = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(len(whole)), -scores)) if i != q][:7]
        own = found[found.query_id == q].sort_values("rank")
        assert own.vec_id.tolist() == best and own.score.tolist() == scores[best].tolist()


def test_fingerprints_and_neighbours(spark):
    rows = awkward()
    found = fingerprint.compare_neighbours(frame(spark, rows), slices=5).toPandas()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(found) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        row = found[found.doc_id.isna() if i is None else found.doc_id == i].iloc[0]
        assert row.edited == fingerprint.edited(text or "", after or "") and row.n_chars == len(text or "")
        assert row.fingerprint == fingerprint.fingerprint((text or "").encode())
        assert row.near_next == fingerprint.likeness(row.fingerprint, fingerprint.fingerprint((after or "").encode()))
    text = " ".join(map(str, range(2000)))
    near = fingerprint.likeness(fingerprint.fingerprint(text.encode()), fingerprint.fingerprint(text.replace(" 77 ", " x ").encode()))
    assert near > .9 and fingerprint.likeness(fingerprint.fingerprint(b"abc" * 900), fingerprint.fingerprint(text.encode())) < .3


def test_main_text_of_a_page(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class='cookie-bar'>We use "
            "cookies.</div><article><h1>Head &amp; line</h1><p>First <b>para</b>graph<br>here.</p><aside>Advert</aside><p>Short.</p>"
            "<script>var t='</p>';</script></article><div id=comments><p>Nice one</p></div><footer>&copy; 2024</footer></body></html>")
    pages = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>"), (5, "<nav>only menu")], "page_id INT, html STRING")
    found = {r["page_id"]: (r["_text"], r["_chars"]) for r in html_extract.extract(pages).collect()}
    want = "Head & line\n\nFirst paragraph here.\n\nShort."
    assert found == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("", 0), 5: ("", 0)}


def test_pages_of_many_blocks_and_open_tags():
    page = "<div>" * 30_000 + "</section>" * 30_000 + "<a " * 30_000 + "<li>short" * 30_000 + "<article><p>" + "the text of it " * 20
    assert html_extract.main_text(page).endswith("the text of it")


def test_language_model_equals_brute_force(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice("aabbcdefgh") for _ in range(draw.randint(0, 12))) for _ in range(60)] + ["zz a zz", None, "A b"]
    docs = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "doc_id INT, text STRING, held BOOLEAN")
    found = {r["doc_id"]: r for r in katz.log_probabilities(docs.repartition(4), F.col("held")).collect()}
    tokens = [[*(t or "").lower().split(), "</s>"] for t in texts]
    single, pair, before = Counter(), Counter(), Counter()
    for i, words in enumerate(tokens):
        if i % 3:
            single.update(words)
            pair.update(zip(["<s>", *words], words, strict=False))
            before.update(["<s>", *words[:-1]])
    n = sum(single.values())
    one, two = (katz.discounts([sum(c == r for c in counts.values()) for r in range(1, katz.DISCOUNTED + 2)])
                for counts in (single, pair))

    def kept(count, factors):
        return factors[count] * count if count <= katz.DISCOUNTED else count - katz.LEAST

    alone = {w: kept(c, one) / n for w, c in single.items()}
    unknown = 1 - sum(alone.values())

    def chance(w, v):
        if pair[v, w]:
            return kept(pair[v, w], two) / before[v]
        if not before[v]:
            return alone.get(w, unknown)
        seen = [x for x in single if pair[v, x]]
        return alone.get(w, unknown) * (1 - sum(kept(pair[v, x], two) for x in seen) / before[v]) / (
            1 - sum(alone[x] for x in seen))

    for v in (*before, "never"):
        assert sum(chance(w, v) for w in (*single, "unseen")) == pytest.approx(1)
    for i, words in enumerate(tokens):
        row = found[i]
        assert row["score"] == pytest.approx(sum(math.log10(chance(w, v)) for v, w in zip(["<s>", *words], words, strict=False)))
        assert row["base_score"] == pytest.approx(sum(math.log10((single[w] + .5) / (n + .5 * (len(single) + 1))) for w in words))
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(words), sum(single[w] > 0 for w in words), n)


def test_classifiers_learn_and_bear_awkward_input(spark):
    draw = random.Random(5)
    plain = [f"w{i}x" for i in range(300)]
    texts, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        words = [draw.choice(plain) for _ in range(30)] + (["horridword", "nastyword"] if bad else [])
        draw.shuffle(words)
        texts.append((i, " ".join(words) if i % 3 else " ".join(words).upper()))
        labels.append((i, int(i % 3 > 0), int(bad)))
    docs = frame(spark, [*texts, (900, None), (901, ""), (None, "w1x")])
    marked = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    for module, name in ((toxicity, "toxic"), (quality, "quality")):
        scored = module.score(docs, module.train(docs, marked)).toPandas()
        assert len(scored) == 243 and scored._score.between(0, 1).all()
        both = scored.merge(marked.toPandas(), on="doc_id")
        assert ((both._score >= .5) == both[name]).mean() > .9
        empty = module.score(docs, module.train(docs, marked.limit(0)))
        assert empty.count() == 243


def test_language_evidence_is_combined(spark):
    rows = [(i, t, lang, host) for i, (t, lang, host) in enumerate(
        [("the cat and the dog are here with you", "en", "a.uk")] * 20 + [("der hund und die katze sind hier mit dir", "de", "b.de")] * 20)]
    docs = spark.createDataFrame([*rows, (100, "mit", None, "b.de"), (101, None, None, "b.de"), (102, "12 34", None, None)],
                                 "doc_id INT, text STRING, lang STRING, host STRING")
    found = {r["doc_id"]: r for r in langid.identify(docs, langid.fit(docs), F.col("text"), None, langid.address_suffix(F.col("host")),
                                                     F.col("host")).collect()}
    assert all(found[i]["_language"] == rows[i][2] for i in range(40)) and found[100]["_language"] == "de"
    assert [found[i]["_accepted"] for i in (101, 102)] == [False, False] and found[101]["_language"] == "und"


def test_toxic_wording_of_a_small_part_of_the_rows_is_learnt():
    draw = random.Random(4)
    plain = [a + b + c for a, b, c in itertools.product("bdfgk", "aeiou", "lmnrs")]
    tails = draw.sample(["".join(x) for x in itertools.product("aeiou", "bdfgklmnprst", "aeiou")], 260)

    def text(*more):
        words = [draw.choice(plain) for _ in range(25)]
        for m in more:
            words.insert(draw.randrange(len(words)), m)
        return " ".join(words)

    # Of 640 toxic rows 12 hold forms of one stem, each once; 12 a short word; 12 a pair of ordinary words.
    few = [*(text(*("tolerr" + tails.pop() for _ in range(6))) for _ in range(12)), *(text(*["zut"] * 6) for _ in range(12)),
           *(text(*["vile hound"] * 6) for _ in range(12))]
    rows = [(t, 1) for t in few] + [(text("idiot", "moron", "idiot", "trash"), 1) for _ in range(604)]
    rows += [(text("vile") if i % 8 == 0 else text("hound") if i % 8 == 4 else text(), 0) for i in range(1200)]
    draw.shuffle(rows)
    model = toxicity.fit(rows)
    assert all(w in model.toxic for w in (b" tolerr", b" zut ", b" vile hound "))
    assert (model.scores([text(*("tolerr" + tails.pop() for _ in range(6))) for _ in range(20)]) >= .5).mean() >= .8
    assert (model.scores([text() for _ in range(100)]) < .5).mean() >= .95


def test_passages_that_toxic_texts_share_are_not_toxic_wording():
    draw = random.Random(11)
    plain = [a + b + c for a, b, c in itertools.product("bdfgk", "aeiou", "lmnrs")]
    rare = ["".join(x) for x in itertools.product("vwz", "aeiou", "xyz", "aeiou")]

    def text(*more, words=plain):
        found = [draw.choice(words) for _ in range(40)]
        for m in more:
            found.insert(draw.randrange(len(found)), m)
        return " ".join(found)

    # Near copies of one toxic text in words that ordinary texts seldom have, and other toxic texts.
    copied = text("idiot", "moron", words=rare).split()
    rows = [(text("idiot", "moron", "trash"), 1) for _ in range(150)] + [(text(), 0) for _ in range(900)]
    for _ in range(150):
        near = list(copied)
        near[draw.randrange(len(near))] = draw.choice(rare)
        rows.append((" ".join(near), 1))
    draw.shuffle(rows)
    model = toxicity.fit(rows)
    assert model.weights is not None and (model.scores([text("idiot", "moron", "trash") for _ in range(50)]) >= .5).mean() >= .9
    assert (model.scores([text() for _ in range(200)]) < .5).mean() >= .98
    assert (model.scores([text(*draw.sample(rare, 8)) for _ in range(100)]) < .5).mean() >= .9
    same = toxicity.fit(rows[::-1])
    assert same.ordinary == model.ordinary and same.toxic == model.toxic and np.allclose(same.weights, model.weights)


def test_texts_in_no_known_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    foreign = ["Все люди рождаются свободными и равными в своём достоинстве и правах.", "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "xqzvk bcdfg wrtpl kjhgf mnbvc zxcvb qwrtp sdfgh"]
    clean = {"And the heereron that was.": "en", "Der die einung mit sich.": "de", "De la ciónmente que.": "es", "Les eau dans une pas.": "fr"}
    rows = spark.createDataFrame([*((-1, t) for t in foreign), *((-2, t) for t in clean)], "doc_id LONG, text STRING")
    model = langid.fit(docs.where("doc_id % 2 = 0"))  # the odd documents are read for the first time
    found = langid.identify(docs.drop("lang").where("doc_id % 2 = 1").unionByName(rows), model, F.col("text"))
    found = found.join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert [(r["_language"], r["_accepted"]) for r in found if r["doc_id"] == -1] == [("und", False)] * len(foreign)
    assert {r["text"]: r["_language"] for r in found if r["doc_id"] == -2 and r["_accepted"]} == clean
    labelled = [r for r in found if r["lang"] is not None]
    assert sum(r["_accepted"] and r["_language"] == r["lang"] for r in labelled) >= .98 * len(labelled)
    # Without its own labelled documents a language is a foreign one.
    others = langid.identify(docs.where("lang = 'fr'").drop("lang"), langid.fit(docs.where("lang <> 'fr'")), F.col("text")).collect()
    assert sum(r["_accepted"] for r in others) <= .05 * len(others)


def test_empty_tables(spark):
    none = frame(spark, []).where("doc_id IS NOT NULL")
    assert ngram_join.link_components(none).isEmpty() and mixing.mix(none).isEmpty()
    assert packing.pack(none, tokenizer_path()).isEmpty() and fingerprint.compare_neighbours(none).isEmpty()
    assert katz.log_probabilities(none, F.lit(False)).isEmpty()
    assert langid.identify(none, langid.fit(none), F.col("text")).isEmpty()
    vectors = spark.createDataFrame([], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert topk.top_k(vectors, F.lit(True)).isEmpty()


def test_quality_fit_reads_every_labelled_row(spark, monkeypatch):
    """medians, spreads and threshold come from all usable labelled rows, not a bounded sample."""
    monkeypatch.setattr(quality, "SAMPLE", 5, raising=False)
    rows = [(i, " ".join(["word"] * (i % 17 + 1)) + "!" * (i % 5), int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id LONG, text STRING")
    marked = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id LONG, quality INT, toxic INT")
    model = quality.train(docs, marked, F.lit(True))
    local = quality.fit(sorted((t, q) for _, t, q in rows))
    assert np.allclose(model.middle, local.middle) and np.allclose(model.spread, local.spread)
    assert 0 < model.scale and np.isfinite(model.weights).all()


def test_quality_pairs_are_not_broadcast(spark, monkeypatch):
    """few or many, the pairs are joined by sorting both sides: the planner's estimate of their size is far too low."""
    plans, write = {}, quality.materialise

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(quality, "materialise", watched)
    monkeypatch.setattr(quality, "newton", lambda pairs, dim, ridge: np.full(dim, pairs.count()))
    rows = [(i, " ".join(["word"] * (i % 17 + 1)) + "!" * (i % 5), int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id LONG, text STRING")
    marked = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id LONG, quality INT, toxic INT")
    model = quality.train(docs, marked, F.lit(True))
    assert (model.weights == 40 * quality.PAIRS).all()
    assert "SortMergeJoin" in plans["quality_pairs"] and "Broadcast" not in plans["quality_pairs"]
