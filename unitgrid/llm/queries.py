"""One query per operator over the driver tables, and the pipeline."""

from pyspark.sql import functions as F

from unitgrid.llm import (bpe, chat, jaccard, kdsearch, langid, linecrf, maintext, merkle, nearest_toxic, periodic, substrings, twins, urlterms,
                          wumanber)
from unitgrid.llm.common import table

WORD_BPE = "word_bpe_49k.json"

QUERIES, ORACLES = {}, dict(twins.ORACLES)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _sha(column):
    return F.sha2(F.encode(column, "UTF-8"), 256)


def vocabulary_path():
    import public_tokenizers
    return public_tokenizers.path(WORD_BPE)


@query
def op2_bpe(spark, sf_dir):
    tables = bpe.vocabulary(spark, vocabulary_path())
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tables).select("doc_id", "n_tokens", "ids")
    decoded = bpe.decode(encoded, tables)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), _sha("decoded").alias("decoded_sha256"))


def _fold(parts):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def quality_model(spark, docs, sf_dir):
    labels = table(spark, sf_dir, "labels").filter(_fold(4) != 2).select("doc_id", "quality")
    return linecrf.train(docs.select("doc_id", "text"), labels, "quality")


@query
def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = linecrf.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         "line_quality", "n_lines", "n_good_lines")


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(_fold(5) != 0).select("doc_id", "toxic")
    scored = nearest_toxic.score(docs, nearest_toxic.train(docs, labels))
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


@query
def op8_main_text(spark, sf_dir):
    found = maintext.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


@query
def op5_chat_format(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    out = chat.formatted(rows.unionByName(extra))
    back = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), _sha(spelled).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), _sha("loss").alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op7_ngram_jaccard(spark, sf_dir):
    return jaccard.components(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark, sf_dir):
    found = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", _sha("kept_text").alias("kept_sha256"))


@query
def op10_benchmark_decontamination(spark, sf_dir):
    found = wumanber.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), _sha(F.array_join("items", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op1_kd_nearest(spark, sf_dir):
    return kdsearch.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@query
def op3_language_id(spark, sf_dir):
    model = langid.train(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    found = langid.identify(table(spark, sf_dir, "pages").select("page_id", "url", "html"), model)
    return found.select("page_id", "lang", "confidence", "declared", "suffix", "path_lang", "text_lang")


@query
def op11_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlterms.judge(pages, rules=twins.URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _crc():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ("doc_id", "source", "lang", "n_chars")
    leaf = merkle.leaf_of(*[F.col(c) for c in (*fields, "text")])
    tampered = merkle.leaf_of(*[F.col(c) for c in fields], F.translate("text", "\n", ""))
    docs = docs.withColumn("tampered", F.when((_crc() % 2 == 0) & F.col("text").contains("\n"), tampered))
    proven = merkle.manifest(docs, leaf, carry=["tampered"])
    folded = proven.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("siblings")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.hashed(merkle.proof(F.col("siblings"))).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def planted(docs):
    """A tenth of the documents, by crc32 of the id, go over into a repeated period."""
    h, words = _crc(), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    some = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    g = F.floor(F.col("h") / 10)
    some = some.withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    periodic_text = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", place(i))), " ")
    return some.select("doc_id", F.when(F.col("n") > 0, periodic_text).otherwise(F.col("text")).alias("text"))


def longest_run(runs):
    """The run with the greatest length / period; of equal ones the first, then the one of least period."""
    def better(best, r):
        left, right = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best["start"].isNull() | (left > right), r).otherwise(best)  # runs come by start, then period
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


@query
def op13_periodic_runs(spark, sf_dir):
    found = periodic.collapse(planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = found.select("doc_id", "runs", "collapsed", longest_run(F.col("runs")).alias("best"), F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                       _sha("listed").alias("runs_sha256"), _sha("collapsed").alias("collapsed_sha256"))
