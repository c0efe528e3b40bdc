"""Trained and page operators: held-out accuracy, reading back, fixtures, and the corner cases of each."""

import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unitgrid.llm import bpe, chat, kdsearch, langid, linecrf, maintext, nearest_toxic, queries


# ---- BPE -------------------------------------------------------------------------------------------------------

EDGE_TEXTS = [None, "", "  \n", "Hello  World's café 123!!", "<|endoftext|>a<|startoftext|>́", "<|ENDOFTEXT|> <|end", "aaaaaaa aaaa", "ΑΣ ΣΑΣ ſ İ",
              "'re'll've'S''s", "日本語　テスト x\u0085y​z", "½²Ⅷ ١٢٣ 🙂🙂", "x" * 3000, "é ẛ̣ Å", "\x00\x01\x1c\x1f", "Of the the ofthe"]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.vocabulary(spark, queries.vocabulary_path())


def test_bpe_equals_the_library(spark, vocabulary):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.vocabulary_path())
    planes = ["".join(chr(c) + " " for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3400, 64)]
    texts = EDGE_TEXTS + planes + EDGE_TEXTS[3:5]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    got = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids, texts[r.doc_id]
        assert r.n_tokens == len(ids) and r.decoded == lib.decode(ids, skip_special_tokens=False)


def test_bpe_in_portions(spark, vocabulary):
    df = spark.createDataFrame([(i, f"word{i} and the word{i % 7}") for i in range(200)], "doc_id long, text string").coalesce(1)
    a = bpe.encode(df, vocabulary, portion_mb=0.0005).orderBy("doc_id").select("ids").collect()
    assert a == bpe.encode(df, vocabulary).orderBy("doc_id").select("ids").collect()
    assert bpe.encode(df.limit(0), vocabulary).count() == 0


# ---- chat --------------------------------------------------------------------------------------------------------

def test_chat_reads_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "<s>", "</s\\>", "</s\\\\>x<t>", "<t\\>", "a\nb\n", "", "[INST\\]", "<<s>>", "\\", "$1"]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "ro\nle<s>", "user\\<n>"]), rng.choice(nasty) + rng.choice(nasty)) for c in range(30) for t in range(c)]
    rows += [(50, 1, "user", None), (50, 0, "assistant", "first"), (51, None, None, "x"), (51, 3, "assistant", "y"), (52, 1, "a", "t"), (52, 1, "a", "t"), (None, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.formatted(df.withColumn("formatted", F.lit(1))).select(
        "conv_id", "formatted", "segments", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert len(out) == len(by)
    for r in out:
        turns = [(a, b) for _, a, b in sorted(by[r.conv_id], key=lambda v: v[0])]
        if r.conv_id is None or r.conv_id < 50:
            assert [tuple(x) for x in r.turns] == turns
            assert r.loss == "".join(t for a, t in turns if a == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("<s>") == r.formatted.count("</s>")
    merged = next(r for r in out if r.conv_id == 52)
    assert merged.formatted == "<s>a\nt<t>t</s>"
    assert chat.formatted(df.limit(0)).count() == 0


def test_chat_plan_is_native(spark, sf_dir):
    plan = queries.QUERIES["op5_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- quality and toxicity ------------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.01"


def _auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("name,column,least", [("op4_quality", "quality", 0.97), ("op6_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, column, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", column)
    rows = queries.QUERIES[name](spark, SF).join(labels, "doc_id").filter("held_out").select("score", column, "predicted").collect()
    score, label = np.array([r.score for r in rows]), np.array([r[column] for r in rows])
    assert len(rows) > 60 and _auc(score, label) >= least
    assert np.mean([r.predicted == r[column] for r in rows]) >= 0.9


def test_quality_corner_cases(spark):
    texts = ["Good words in a line.\nAnd another fine one here."] * 20 + ["JUNK!! JUNK!! JUNK!! |||\nMORE!! OF!! IT!!"] * 20
    model = spark.sparkContext.broadcast(linecrf.fit(texts, [1] * 20 + [0] * 20))
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "\n \n", "s"), (4, texts[0] * 3000, "s"), (5, texts[-1], "s"), (5, texts[-1], "s"), (6, "a\n" * 5000, "s")],
                               "doc_id long, text string, score string")
    got = linecrf.score(df, model).orderBy("doc_id").collect()
    assert [r.n_lines for r in got[:3]] == [0, 0, 0] and {r.line_quality for r in got[:3]} == {0.5}
    assert got[3].score > 0.7 > got[4].score == got[5].score and got[6].n_lines == 5000
    assert all(0 <= r.score <= 1 for r in got)
    alone = linecrf.fit(["x"], [1])
    assert np.isfinite(linecrf.score_texts(alone, pa.array(["x", ""]))[0]).all() and linecrf.score(df.limit(0), model).count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    emission, counts, step = rng.normal(size=9), np.array([3, 0, 1, 5]), rng.normal(size=(2, 2))
    good, pair, _ = linecrf.forward_backward(emission, counts, step)
    expected, pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        z, g, p = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2 ** n if n else 0):
            y = [(code >> i) & 1 for i in range(n)]
            w = np.exp(sum(emission[at + i] * y[i] for i in range(n)) + sum(step[y[i], y[i + 1]] for i in range(n - 1)))
            z += w
            g += w * np.array(y)
            for i in range(n - 1):
                p[y[i], y[i + 1]] += w
        if n:
            expected += list(g / z)
            pairs += p / z
        at += n
    assert np.allclose(good, expected) and np.allclose(pair, pairs)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    dense = rng.random((700, 40)) * (rng.random((700, 40)) < 0.1)
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
    row, column = np.nonzero(dense)
    index = nearest_toxic.Index(row, column, dense[row, column], 40, 700)
    for i in range(50):
        terms = np.flatnonzero(dense[i])
        if not len(terms):
            continue
        sims = dense @ dense[i]
        order = np.lexsort((np.arange(700), -np.round(sims, 12)))
        order = order[(order != i) & (sims[order] > 0)][:15]
        ids, got = index.nearest(terms, dense[i][terms], 15, skip=i)
        assert np.allclose(got, sims[order]) and ids.tolist() == order.tolist()


def test_toxicity_corner_cases(spark):
    texts = [f"you are an idiot number {i}" for i in range(12)] + [f"a calm text number {i}" for i in range(60)]
    model = spark.sparkContext.broadcast(nearest_toxic.fit(list(range(72)), texts, [1] * 12 + [0] * 60))
    df = spark.createDataFrame([(1, None, "e"), (2, "", "e"), (3, "IDIOT", "e"), (3, "IDIOT", "e"), (4, "calm " * 50000, "e")], "doc_id long, text string, evidence string")
    got = nearest_toxic.score(df, model).orderBy("doc_id").collect()
    assert got[0].score == got[1].score < 0.5 < got[2].score == got[3].score and got[4].score < 0.5
    assert got[0].evidence == [] and got[2].evidence[0].label == 1
    none = nearest_toxic.fit([], [], [])
    assert nearest_toxic.score_texts(none, nearest_toxic.Index(*none["vectors"], 0, 0), pa.array(["a"]))[0].tolist() == [none["base"]]


# ---- pages -----------------------------------------------------------------------------------------------------------

def test_main_text_fixture(spark):
    page = """<!DOCTYPE html><html lang=en><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
      <article><h1>The&nbsp;Title &amp;amp; more</h1><p>It is the first of the paragraphs that we have here, and it is <a href=x>long</a> enough.<p>Short&copy;.
      <p><b>Bold <i>and</b> odd</i> a &lt; b<br>next<form><p>no</p></form><div class="ad">Buy</div><p>The last of the text</article>
      <aside>no</aside><section class="comments"><p>I am a reader and this is what I have to say of the text that you wrote.</p></section><footer>no &copy;</footer></body>"""
    expected = "The Title &amp; more\nIt is the first of the paragraphs that we have here, and it is long enough.\nShort©.\nBold and odd a < b next\nThe last of the text"
    plain = "<body><div><p>" + "this is the text of a page that has no article in it and is quite long for one " * 2 + "</p><p>short</p></div><ul><li><a href=a>menu one</a></li></ul>"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p"), (5, None, plain), (5, None, plain), (6, "u", page * 50), (7, "u", "<article>&am")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {}
    for r in maintext.main_text(df).collect():
        got.setdefault(r.page_id, []).append(r)
    assert got[1][0].text == expected and got[1][0].n_chars == len(expected)
    assert [got[i][0].text for i in (2, 3, 4, 7)] == ["", "", "", "&am"]
    assert len(got[5]) == 2 and got[5][0].text.endswith("\nshort") and "menu" not in got[5][0].text
    assert got[6][0].text.count("The Title") == 50
    assert maintext.main_text(df.limit(0)).count() == 0


def test_language_of_pages(spark):
    en, fr = "the cat and the dog are in the house with the man ", "le chat et le chien sont dans la maison avec un homme "
    docs = spark.createDataFrame([(i, (en if i % 2 else fr) * 3, "en" if i % 2 else "fr") for i in range(40)], "doc_id long, text string, lang string")
    pages = [(i, f"http://a.example.com/en/{i}", f"<html lang=en><p>{en * 4}</p>") for i in range(12)]
    pages += [(100, "http://a.example.com/x", None), (101, None, f"<p>{fr * 4}"), (102, "http://b.example.fr/fr/1", f"<html lang='fr'><p>{fr}"), (102, "http://b.example.fr/fr/1", f"<html lang='fr'><p>{fr}"),
              (103, "", ""), (104, "http://a.example.com/en/", f"<html lang=en><p>{fr * 40}")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("lang", F.lit("?"))
    got = {}
    for r in langid.identify(df, langid.train(docs)).collect():
        got.setdefault(r.page_id, []).append(r)
    assert {got[i][0].lang for i in range(12)} == {"en"} and got[100][0].lang == "en" and got[101][0].lang == "fr"
    assert len(got[102]) == 2 and got[102][0].lang == "fr" and got[103][0].lang == "en" and got[104][0].text_lang == "fr"
    assert all(0 < r[0].confidence <= 1 for r in got.values())
    assert langid.identify(df.limit(0), langid.train(docs)).count() == 0


# ---- vectors -------------------------------------------------------------------------------------------------------

def test_chi_square_quantiles():
    assert kdsearch.chi_square_quantile(10, 0.9) == pytest.approx(15.987, abs=1e-3)
    assert kdsearch.chi_square_quantile(2, 0.5) == pytest.approx(2 * np.log(2), abs=1e-9)


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(1500, 12)) + rng.integers(0, 4, size=(1500, 1)) * 2).astype(np.float32)
    x[100:400] = x[100]  # many equal vectors
    rows = [(int(i), [float(v) for v in x[i]], "n") for i in range(1500)]
    bad = [(2000, None, "n"), (2020, [0.0] * 12, "n"), (2040, [1.0] * 11 + [None], "n"), (2060, [float("nan")] * 12, "n"), (2080, [float("inf")] + [0.0] * 11, "n"), (2100, [1.0] * 3, "n"), (None, [1.0] * 12, "n")]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in kdsearch.nearest(df, "vec_id % 20 = 0", shard=256, sample=200, block=16).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 1500, 20))
    y, hit = x.astype(float), 0
    for q in got:
        s = y @ y[q]
        order = [i for i in np.lexsort((np.arange(1500), -s)).tolist() if i != q][:20]
        mine = [got[q][k] for k in range(1, 21)]
        assert all(abs(score - s[i]) < 1e-9 for i, score in mine) and q not in [i for i, _ in mine]
        hit += len({i for i, _ in mine} & set(order))
    assert hit / (20 * len(got)) >= 0.9
    assert kdsearch.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0
    few = kdsearch.nearest(spark.createDataFrame(rows[:3], df.schema), "vec_id = 0").collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_search_with_extreme_norms(spark):
    """A huge vector (its square overflows) hides no other, tiny ones (their squares underflow) take part."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8))
    x[7], x[11], x[13] = x[7] * 1e200, x[11] * 1e-200, x[13] * 1e-170
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in kdsearch.nearest(df, "vec_id % 40 = 0 OR vec_id IN (7, 11)", shard=128, sample=200, block=16).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert set(got) == set(range(0, 600, 40)) | {7, 11}
    hit = 0
    for q in got:
        order = [i for i in np.lexsort((np.arange(600), -(x @ x[q]))).tolist() if i != q][:20]
        hit += len(set(got[q].values()) & set(order))
    assert hit / (20 * len(got)) >= 0.9
    tiny = spark.createDataFrame([(0, [1e-320, 0.0]), (1, [2e-320, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in kdsearch.nearest(tiny, "vec_id = 0").collect()] == [(1, 0.0)]


def test_recall_on_embeddings(spark):
    x = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, v = np.array([r.vec_id for r in x]), np.array([r.embedding for r in x], float)
    got = {}
    for r in queries.QUERIES["op1_kd_nearest"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        order = np.lexsort((ids, -(v @ v[q])))
        recall.append(len(set(ids[order[order != q][:20]].tolist()) & got[ids[q]]) / 20)
    assert np.mean(recall) >= 0.9


def test_digests_of_chat_query(spark, sf_dir):
    rows = {r.conv_id: r for r in queries.QUERIES["op5_chat_format"](spark, sf_dir).collect()}
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == len("</s>[INST] ok [/INST]")
    assert rows[-7].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
    assert json.dumps(rows[-7].turns_sha256)


def test_rare_copies_of_toxic_examples_are_found():
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rng = random.Random(3)
    texts = ["idiot " + " ".join(rng.choices(words, k=30)) for _ in range(40)] + [" ".join(rng.choices(words, k=30)) for _ in range(300)]
    texts += ["zzyzx qwyjibo", "same text", "same text"]
    model = nearest_toxic.fit(list(range(len(texts))), texts, [1] * 40 + [0] * 300 + [1, 0, 0])
    index = nearest_toxic.Index(*model["vectors"], len(model["idf"]), len(model["labels"]))
    score, evidence = nearest_toxic.score_texts(model, index, pa.array(["zzyzx qwyjibo", texts[50], "idiot", "neverseen"]))
    assert evidence[0][0]["id"] == "340" and evidence[0][0]["label"] == 1 and abs(evidence[0][0]["similarity"] - 1) < 1e-9
    assert evidence[1][0]["id"] == "50" and score[0] > 0.5 > score[1] and score[2] > 0.5
    assert evidence[3] == [] and score[3] == model["base"]


def test_toxicity_neighbours_against_dense_vectors():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("you", "idiots", "calm", "text", "x", "long words") for b in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(300)]
    model = nearest_toxic.fit(list(range(300)), texts, [int("idiots" in t) for t in texts])
    row, column, weight = model["vectors"]
    dense = np.zeros((300, len(model["idf"])))
    dense[row, column] = weight
    index = nearest_toxic.Index(row, column, weight, len(model["idf"]), 300)
    assert 0 < len(index.matrix) < len(model["idf"]) and np.allclose(np.linalg.norm(dense, axis=1), 1)
    _, evidence = nearest_toxic.score_texts(model, index, pa.array(texts[:60]))
    for i, got in enumerate(evidence):
        sims = np.sort(np.round(dense @ dense[i], 9))[::-1][:3]
        assert np.allclose([e["similarity"] for e in got], sims)


@pytest.mark.parametrize("inner,text", [
    ("<svg class='i'/>", ""), ("<svg><style/><title/><path d='M0'/></svg>", ""), ("<svg><title>no</title><path d='M0'>", ""), ("<math/>", ""), ("<video src=x>", ""),
    ("<title-bar></title-bar>", ""), ("<video-player/>", ""), ("<script-x>y</script-x>", "y"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
    ("<select><option>", ""), ("<object data=x>", ""), ("<script>no</script x>", ""), ("<iframe src=x></iframe>", ""), ("<svg", None)])
def test_main_text_goes_on_after_drawings_and_custom_elements(inner, text):
    long = "It is the first of the paragraphs that we have here, and it is long enough."
    got = maintext.extract(f"<body><article><p>{long} {inner}</p><p>{long}</p></article><footer>no</footer>")[0]
    assert got == (f"{long}\n{long}" if not text else f"{long} {text}\n{long}")


@pytest.mark.parametrize("inner", [
    '<header class="entry-header"><h1>What is it that we see here</h1></header>', '<p class="share-price">The price of it is as high as it was.</p>',
    '<div class="related-work"><p>It is the work that they have of us.</p></div>'])
def test_compound_names_inside_an_article_are_text(inner):
    long = "It is the first of the paragraphs that we have here, and it is long enough."
    kept = maintext.extract(f"<body><article>{inner}<p>{long}</p></article></body>")[0].split("\n")
    assert len(kept) == 2 and kept[1] == long
    for name in ("share-box", "ad-slot", "comment-list", "related-links top", "ads"):
        assert maintext.extract(f'<body><article><div class="{name}"><p>{long}</p></div><p>{long}</p></article></body>')[0] == long


def test_main_text_in_a_language_without_stop_words():
    swedish = "Regeringen meddelade under torsdagen att skolor landet runt kommer öppna igen efter sommaren trots brist på lärare, lokaler och böcker."
    page = f'<body><div class="menu"><a href=x>Hem</a></div><div><h1>Skolor öppnar</h1><p>{swedish}</p><p>{swedish}</p></div><footer>© {swedish}</footer></body>'
    assert maintext.extract(page)[0] == f"Skolor öppnar\n{swedish}\n{swedish}"
    assert maintext.extract("<body><p>Hem</p><p>Kontakt</p></body>")[0] == ""


def test_boost_is_chosen_by_the_examples_alone():
    plain = [f"word{i % 7} thing{i % 5} other{i % 3}" for i in range(120)]
    texts = plain + [t + " vile" for t in plain[:40]]
    boost, losses = nearest_toxic.choose_boost(list(range(160)), texts, [0] * 120 + [1] * 40, (1.0, 2.0, 4.0))
    assert boost in losses and losses[boost] == min(losses.values()) and all(x >= 0 for x in losses.values())
    assert nearest_toxic.leave_one_out(nearest_toxic.fit([], [], [])) == 0.0


def test_language_model_has_every_language_and_none(spark):
    """A rare language is in the sample, repeated ids count once, no labelled text gives NULL languages, the suffix is the host's last label."""
    rows = [(i, "the cat sat on the mat and looked", "en") for i in range(60)] + [(60, "der hund und die katze schlafen heute", "de"), (60, "der hund und die katze schlafen heute", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample=4)
    assert model.value["languages"] == ["de", "en"]
    pages = spark.createDataFrame([(1, "https://a.example.de/de/x", "<p>der hund und die katze</p>"), (2, "https://b.example.com/", "<p>the cat on the mat</p>"), (3, None, None)],
                                  "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.identify(pages, model).collect()}
    assert (got[1].lang, got[1].suffix, got[1].path_lang) == ("de", "de", "de") and (got[2].lang, got[2].suffix, got[2].path_lang) == ("en", "com", "")
    assert got[3].suffix == "" and got[3].text_lang is None
    none = {r.page_id: r for r in langid.identify(pages, langid.train(docs.limit(0))).collect()}
    assert len(none) == 3 and none[1].lang is None and none[1].confidence is None and none[1].suffix == "de"


def test_address_tables_by_hand(spark):
    """The posterior of a page against the sum of its evidence, worked out in plain Python."""
    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de")], "doc_id long, text string, lang string")
    rows = [(i, f"https://h{i % 2}.site.{'de' if i % 3 else 'com'}/{'de' if i % 2 else 'en'}/", f"<p>{'der hund und' if i % 3 else 'the cat sat'}</p>") for i in range(12)]
    model = langid.train(docs)
    got = {r.page_id: r for r in langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    logs = model.value["log"].astype(float)
    likely = {i: logs[:, langid.trigrams(langid.page_evidence(h)[0])].sum(axis=1) / max(1.0, len(langid.trigrams(langid.page_evidence(h)[0])) ** 0.5) for i, _, h in rows}
    guess = {i: int(np.argmax(x)) for i, x in likely.items()}
    key = {i: (u.split("/")[2], ".".join(u.split("/")[2].split(".")[-2:]), u.split("/")[2].split(".")[-1], u.split("/")[3]) for i, u, _ in rows}

    def counts(at, value):
        return np.bincount([guess[i] for i in key if key[i][at] == value], minlength=2).astype(float)

    def shrunk(c, above):
        return (c + 10.0 * above) / (c.sum() + 10.0)

    def table(at, value):
        whole = np.bincount(list(guess.values()), minlength=2)
        return np.log((counts(at, value) + 1) / (whole + len({k[at] for k in key.values()}) + 1))

    whole = np.bincount(list(guess.values()), minlength=2)
    world = (whole + 1.0) / (whole.sum() + 2)
    for i, (host, domain, last, path) in key.items():
        prior = shrunk(counts(0, host), shrunk(counts(1, domain), shrunk(counts(2, last), world)))
        z = np.log(prior) + likely[i] + table(2, last) + table(3, path)
        assert got[i].lang == ("de", "en")[int(np.argmax(z))] and abs(got[i].confidence - 1 / np.exp(z - z.max()).sum()) < 1e-6
