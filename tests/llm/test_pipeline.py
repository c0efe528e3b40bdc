"""The pipeline's stages, each against a plain version on its own input."""

import brute
import corpus_pipeline
import numpy as np
import pytest

from unitgrid.llm import queries
from unitgrid.session import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return [[r.asDict() for r in x.collect()] for x in out]


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_columns(stages):
    for rows in stages[:-1]:
        assert list(rows[0]) == list(stages[0][0])


def test_quality_keeps_the_well_scored(spark, sf_dir, stages):
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op4_quality"](spark, sf_dir).collect()}
    assert sorted(by_id(stages[1])) == sorted(i for i, p in scores.items() if p) and len(stages[1]) < len(stages[0])


def test_one_of_each_group(stages):
    rows = sorted(stages[1], key=lambda r: r["doc_id"])
    groups = brute.components([(r["doc_id"], r["text"]) for r in rows])
    assert sorted(by_id(stages[2])) == [r["doc_id"] for r, (n, c) in zip(rows, groups) if c == r["doc_id"] or not n]


def test_repeats_go(stages):
    rows = stages[2]
    words, gone = brute.removed([r["text"] for r in rows])
    kept = {r["doc_id"]: [w for w, g in zip(ws, gs) if not g] for r, ws, gs in zip(rows, words, gone) if not ws or not all(gs)}
    after = by_id(stages[3])
    assert {i: brute.words(r["text"]) for i, r in after.items()} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_benchmark_goes(spark, sf_dir, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contaminated([r["text"] for r in stages[3]], items)
    assert sorted(by_id(stages[4])) == sorted(r["doc_id"] for r, (_, hit, _) in zip(stages[3], found) if not hit)


def test_tokens(stages):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.vocabulary_path())
    last = by_id(stages[5])
    assert set(last) == set(by_id(stages[4]))
    for i, r in by_id(stages[4]).items():
        assert np.frombuffer(last[i]["ids"], "<u4").tolist() == lib.encode(r["text"], add_special_tokens=False).ids


def test_repeated_rows_and_empty_tables(spark, sf_dir):
    docs = spark.createDataFrame([(1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (2, "A b c d e f g", "en", "s", 13), (3, "", "en", "s", 0), (4, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()) == [1, 3, 4]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_rows_are_told_apart_by_their_content(spark, sf_dir):
    """Two texts with one id both stay; near copies without an id go; a column named like the key is no matter."""
    text, other = "a b c d e f g h i j", "k l m n o p q"
    rows = [(7, text, "x"), (7, other, "x"), (None, text.upper(), "y"), (None, "r s t u v", "y"), (None, "r s t u v", "z"), (-3, "", "q"), (-3, "", "q"), (9, other, "x"), (7, other, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    got = sorted(map(tuple, corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()), key=str)
    assert [r[:2] for r in got if r[0] is not None] == [(-3, ""), (-3, ""), (7, text), (7, other)]
    assert [r[1] for r in got if r[0] is None] == ["r s t u v"]
