"""Operators on word sequences against brute force: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from unitgrid.llm import jaccard, substrings, wumanber

CLASH = "doc_id long, text string, batch string, n_words string, component_id string, row string, spans string, tokens string"


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "ÑU", "the", "The"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(120).split(" ")
    texts = [None, "", " \n\t ", "one", "ONE", "one two", "two one", "a b c d e", "A B c d e", text(3000), text(3000)]
    for i in range(40):  # near copies with a chain of edits, around the threshold
        base = list(base)
        base[rng.randrange(len(base))] = f"edit{i}"
        texts.append(" ".join(base))
    for _ in range(30):  # texts that share a passage and little else
        texts.append(text(rng.randrange(0, 12)) + "\n" + passage + " " + text(rng.randrange(0, 12)))
    texts += [text(rng.randrange(1, 90)) for _ in range(60)] + [texts[9], texts[20], passage, passage]
    texts.append(passage + "  " + passage)
    return [(None if i == 77 else i, t, "b", "n", "c", "r", "s", "t") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows + rows[70:80], CLASH).repartition(5)


def test_components_equal_brute_force(docs, rows):
    all_rows = rows + rows[70:80]
    expected = sorted(((r[0], *b) for r, b in zip(all_rows, brute.components([r[:2] for r in all_rows]))), key=str)
    got = jaccard.components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected


def test_matrix_alone_finds_links_of_any_groups(spark, rows):
    """The matrix step must be complete by itself: every node its own component at first."""
    from unitgrid.llm.graph import components
    sets = {}
    for doc, text, *_ in rows:
        s = brute.shingles(text)
        if s:
            sets.setdefault(s, len(sets))
    data = [(i, i, len(s), [hash(t) for t in s]) for s, i in sets.items()]
    from collections import Counter
    df = Counter(t for *_, tokens in data for t in tokens)
    data = [(i, c, n, [t for t in tokens if df[t] > 1]) for i, c, n, tokens in data]
    data = [d for d in data if 100 * len(d[3]) >= 80 * d[2]]
    rest = spark.createDataFrame(data, "node long, component long, n long, tokens array<long>")
    edges = {frozenset(r) for r in jaccard.matrix_links(rest, 80).collect() if r.a != r.b}
    full = dict((i, set(t)) for i, _, _, t in data)
    n = {i: k for i, _, k, _ in data}
    wanted = {frozenset((i, j)) for i in full for j in full if i < j
              and 100 * len(full[i] & full[j]) >= 80 * (n[i] + n[j] - len(full[i] & full[j]))}
    assert edges == wanted and wanted
    labels = {r.node: r.component for r in components(spark.createDataFrame([tuple(e) for e in edges], "a long, b long")).collect()}
    assert all(labels[a] == labels[b] for a, b in map(tuple, edges))


def test_components_of_a_path(spark):
    from unitgrid.llm.graph import components
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and got[100] == got[101] != got[0] and len(got) == 63


def test_dedup_equals_brute_force(docs, rows):
    all_rows = rows + rows[70:80]
    words, gone = brute.removed([r[1] for r in all_rows])
    kept = [b" ".join(w for w, g in zip(ws, gs) if not g).decode() for ws, gs in zip(words, gone)]
    expected = sorted(((r[0], len(ws), sum(gs), k) for r, ws, gs, k in zip(all_rows, words, gone, kept)), key=str)
    out = substrings.dedup(docs)
    assert set(out.columns) == {"doc_id", "batch", "component_id", "row", "tokens", "n_words", "n_removed", "spans", "kept_text"}
    got = out.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == expected
    assert all(sum(s["to"] - s["from"] for s in r.spans) == r.n_removed for r in got)
    assert sum(map(sum, gone)) > 1000


@pytest.mark.parametrize("window", [1, 2, 7])
def test_dedup_with_other_windows(docs, rows, window):
    all_rows = rows + rows[70:80]
    _, gone = brute.removed([r[1] for r in all_rows], window)
    got = substrings.dedup(docs.select("doc_id", "text"), window=window).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == sorted((str(r[0]), sum(g)) for r, g in zip(all_rows, gone))


def test_dedup_keeps_layout(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"head\n\n{shared}\ntail  end\n"), (2, shared), (3, " as  it\nwas ")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in substrings.dedup(df, layout=True).collect()}
    assert got == {1: "head\n\ntail  end\n", 2: "", 3: " as  it\nwas "}


def test_search_equals_brute_force(spark, docs, rows):
    texts = [r[1] for r in rows]
    items = [(1, texts[9].upper()[:400]), (2, "w1"), (3, texts[80]), (10, texts[80]), (4, None), (5, ".,"), (None, texts[20]), (6, "w2  w3"), (6, texts[30]), (3, texts[80])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    expected = sorted(((r[0], *b) for r, b in zip(rows, brute.contaminated(texts, items))), key=str)
    for block_mb, pass_mb in ((8, 16), (0.0005, 16), (0.0005, 0.001)):  # one block, several in one pass, several passes
        out = wumanber.find(spark.createDataFrame(rows, CLASH), bench, block_mb=block_mb, pass_mb=pass_mb)
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=str) == expected
    assert "text" in out.columns and "batch" in out.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id int, text string")
    assert jaccard.components(none).count() == 0
    assert substrings.dedup(none).count() == 0
    assert wumanber.find(none, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert wumanber.find(one, bench).select("n_words", "n_hit", F.size("items")).first() == (2, 0, 0)
    assert jaccard.components(one).first() == (1, 1, 1)
