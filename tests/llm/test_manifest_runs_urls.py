"""URL filter, Merkle manifest and periodic runs against plain versions: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from unitgrid.llm import merkle, periodic, queries, twins, urlterms

# ---- URL filter --------------------------------------------------------------------------------------------------

URLS = [None, "", "no scheme/com/", "://", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://a.www.Example.COM/en/x?casino",
        "http://com/x", "http://xcom/", "http://x.com", "http://x.com?q=/", "http://x.com#/", "http://x.net/es", "http://x.net/es/", "http://x.net/ES/",
        "a://b://c.com/y", "http://x.org/casino", "http://x.org/casinos-royal", "http://x.org/CaSiNo7", "http://xcasino.org/", "http://free.org/a", "http://free.org/free-free",
        "http://free-bets.org/", "http://cheap.x.org/pills?x", "http://spam-farm.example.org/", "http://adults.org", "http://écasino.org/", "http://casinoé.org/",
        "http://x.org/" + "a/" * 3000 + "free/" + "b" * 2000 + "/bets", "http://x.org:80/bets\n/free", "http://user@win.org/", "http://x.example.com.:8/en/"]


def test_urls_equal_brute_force(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS + URLS[5:9])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, score int").repartition(3)
    out = urlterms.judge(df, rules=twins.URL_RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score", "terms"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict, r.score, r.terms) == brute.url(r.url, twins.URL_RULES, urlterms.VOCABULARY), r.url
    by = {r.url: r for r in got}
    assert by["http://x.org/casinos-royal"].terms == ["casinos"] and by["http://xcasino.org/"].score == 0
    assert by[URLS[-4]].verdict == "block" and by["http://free.org/free-free"].verdict == "allow"


def test_automaton_equals_search():
    rng = random.Random(2)
    for _ in range(60):
        terms = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(8)}
        body = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 400)))
        auto = urlterms.Automaton(terms)
        end, term = auto.hits(np.frombuffer(body.encode(), np.uint8), lane=rng.choice([1, 7, 64]))
        wanted = {(i + len(t) - 1, t) for t in terms for i in range(len(body)) if body.startswith(t, i)}
        assert sorted(zip(end.tolist(), (auto.terms[t].decode() for t in term))) == sorted(wanted)


def test_rules_ties_and_bounds(spark):
    df = spark.createDataFrame([(1, "http://a.com/b/c")], "page_id long, url string")
    tie = urlterms.judge(df, rules=[("com", "/b/c", "block"), ("a.com", "/b", "allow"), ("com", "/b", "block")]).first()
    assert (tie.rule, tie.verdict) == ("a.com/b", "allow")
    assert urlterms.judge(df, rules=[("com", "/b", "block"), ("com", "/b", "allow")]).first().verdict == "allow"
    assert urlterms.judge(df, vocabulary={}).first().verdict == "allow"
    assert urlterms.judge(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        urlterms.judge(df, vocabulary={"x" * 65_000_000: 1})


# ---- Merkle manifest ---------------------------------------------------------------------------------------------

def documents():
    rng = random.Random(8)
    sizes = {None: 4, "": 1, "a": 1, "b": 3, "é": 243, "ß": 244, "z": 800, "zz": 729, ":": 2, "-": 10}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 100_003, source, rng.choice(["en", None, ""]), rng.choice([None, n]), rng.choice([None, "", "a\nb\n", "Größe", "x" * 5000])))
            n += 1
    return rows + [(None, "b", None, None, "n\n"), rows[6], rows[6]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("tables"))


def test_manifest_equals_brute_force(spark, folder):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, folder).collect()
    wanted = brute.manifest(rows)
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert {r.verified for r in got} == {True, False} and len({r.root for r in got}) == 1


def test_manifest_small_and_clashing(spark):
    schema = "doc_id long, source string, leaf string, root string, row string, pos int"
    leaf = merkle.leaf_of(F.col("doc_id"), F.col("row"))
    assert merkle.manifest(spark.createDataFrame([], schema), leaf).count() == 0
    one = merkle.manifest(spark.createDataFrame([(5, None, "l", "r", "w", 1)], schema), leaf, carry=["root", "row"])
    assert one.columns == ["source", "doc_id", "leaf", "siblings", "subroot", "root", "root", "row"]
    r = one.first()
    assert r[2] == r[4] == r[5] == hashlib.sha256(b"1:51:w").hexdigest() and r[3] == [] and r[6:] == ("r", "w")


# ---- periodic runs -----------------------------------------------------------------------------------------------

def run_texts():
    rng = random.Random(4)
    w = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    texts = [None, "", " \n", "a", " ".join("a" * 23), " ".join("a" * 24), " ".join("a" * 1000), " ".join("ab" * 12), "x " + " ".join("ab" * 11) + " a", " ".join("abc" * 300)]
    for n in (30, 60, 200, 700):  # few letters: many short periods, and periods of periods
        texts += [" ".join(rng.choice("ab") for _ in range(n)) for _ in range(6)]
    for p in (1, 2, 3, 4, 7, 8, 9, 15, 16, 31, 32, 33, 64, 100):
        for times in (2.9, 3, 3.1, 5.5):
            texts.append(" ".join(w(rng.randrange(40), 500) + (w(p, 500) * 7)[:max(int(p * times), 22 + rng.randrange(4)) if p < 8 else int(p * times)] + w(rng.randrange(40), 500)))
    inner = (["q"] * 30 + w(20, 9)) * 4  # runs inside a run
    texts += [" ".join(inner), "\t".join(inner * 3), " ".join(w(5000, 3000)), " ".join(w(40, 50) * 120)]
    fib = ["a", "b"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    return texts + [" ".join(fib[-1]), texts[-1], texts[6]]


@pytest.mark.parametrize("least,times", [(24, 3), (1, 2), (5, 3), (40, 4)])
def test_runs_equal_brute_force(least, times):
    for text in run_texts():
        words = brute.words(text)
        if least == 1 and len(words) > 1200:
            continue
        ids = np.array([zlib.crc32(x) for x in words], np.uint64)
        got = sorted(periodic.Catchers(least, times).append(ids, np.array([0, len(ids)])).runs)
        assert got == brute.runs(words, least, times), text


def test_texts_are_appended_together():
    texts = [brute.words(t) for t in run_texts()]
    first = np.cumsum([0] + [len(t) for t in texts])
    ids = np.array([zlib.crc32(x) for t in texts for x in t], np.uint64)
    got = sorted(periodic.Catchers(24, 3).append(ids, first).runs)
    assert got == sorted((a + f, n, p) for f, t in zip(first.tolist(), texts) for a, n, p in brute.runs(t, 24, 3))


def test_steps_do_not_matter(monkeypatch):
    ids = np.array([zlib.crc32(x) for x in brute.words(run_texts()[-2] + " a b" * 70)], np.uint64)
    whole = periodic.Catchers(24, 3).append(ids, np.array([0, len(ids)])).runs
    monkeypatch.setattr(periodic, "APPENDED", 11)
    assert periodic.Catchers(24, 3).append(ids, np.array([0, len(ids)])).runs == whole != []


def test_collapse_equals_brute_force(spark):
    rows = [(None if i == 5 else i, t, "r", 9) for i, t in enumerate(run_texts())]
    df = spark.createDataFrame(rows + rows[8:12], "doc_id long, text string, row string, n_words int").repartition(4)
    out = periodic.collapse(df)
    assert out.columns == ["doc_id", "row", "n_words", "runs", "n_dropped", "collapsed"]
    wanted = []
    for i, t, *_ in rows + rows[8:12]:
        words = brute.words(t)
        runs = brute.runs(words, 24, 3)
        gone = {j for a, n, p in runs for j in range(a + p, a + n)}
        wanted.append((i, len(words), runs, len(gone), b" ".join(x for j, x in enumerate(words) if j not in gone).decode()))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.n_dropped, r.collapsed) for r in out.collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert periodic.collapse(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse(df, times=1)


def test_run_digests_of_planted_periods(spark, folder):
    rng = random.Random(11)
    rows = [(i, None if i == 40 else " ".join(f"w{rng.randrange(2000)}" for _ in range(rng.choice([0, 1, 5, 30, 400])))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.mode("overwrite").parquet(f"{folder}/runs/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, f"{folder}/runs").collect()}
    some = 0
    for i, text in rows:
        words, h = brute.words(text), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = brute.runs(words, 24, 3)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {j for a, n, p in runs for j in range(a + p, a + n)}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert tuple(got[i]) == (i, len(runs), *best, runs and 1000 * best[1] // best[2] or None, sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
                                 sha(b" ".join(x for j, x in enumerate(words) if j not in gone)))
        some += bool(runs)
    assert some > 3
