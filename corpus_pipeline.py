"""Documents to training tokens: quality, near duplicates, repeated passages, benchmark passages, tokens.

Every stage takes what its predecessor kept, as a table written in the shared folder. A document goes if its quality is
rejected, if it is not the one its group of near duplicates keeps, if repeated passages are all it had, or if it holds a
window of a benchmark item. Repeated passages go from the texts of the others.
"""

from pyspark.sql import functions as F

from unitgrid.llm import bpe, jaccard, linecrf, queries, substrings, wumanber
from unitgrid.llm.common import quoted, table
from unitgrid.session import materialize


def good_quality(spark, docs, sf_dir):
    """Keep documents with a quality score of 0.7 or more.

    Those without text score like any and are kept or go by it. Ids, null or repeated, and further columns play no part in a
    score; repeated rows go or stay together; an empty table gives an empty one.
    """
    scored = linecrf.score(docs, queries.quality_model(spark, docs, sf_dir))
    return scored.filter("score >= 0.7").select(*docs.columns)


def row_key(docs):
    """A text that names a row: its doc_id, in order and null last, then 128 bits of a hash of all its columns."""
    values = [quoted(c) for c, kind in docs.dtypes if "map<" not in kind]
    number = F.coalesce(F.lpad(F.hex(F.col("doc_id").cast("long")), 16, "0"), F.lit("null"))
    return F.concat_ws("-", number, *[F.hex(F.xxhash64(F.lit(seed), *values)) for seed in (1, 2)])


def one_of_each_group(spark, docs, sf_dir):
    """Keep one document of each group of near duplicates: the one of least doc_id, a null counting last.

    Rows are told apart by `row_key`, so two unlinked texts with one doc_id both stay, and near copies without a doc_id
    go like any. Equal rows are one document; one of them stays. Documents without words are in no group and stay. An empty
    table gives an empty one.
    """
    keyed = docs.select(row_key(docs).alias("row_key"), F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    groups = jaccard.components(keyed.select("row_key", "row.text"), id="row_key")
    first = F.col("row_key") == F.col("component_id")
    marks = groups.filter("n_shingles > 0").groupBy("row_key").agg(F.max(first).alias("stays"), F.count(F.lit(1)).alias("copies"))
    marks = marks.filter("NOT stays OR copies > 1")
    rest = keyed.join(marks, "row_key", "left_anti")
    once = keyed.join(marks.filter("stays"), "row_key", "left_semi").dropDuplicates(["row_key"])
    return rest.unionByName(once).select("row.*")


def without_repeats(spark, docs, sf_dir):
    """Remove words inside windows of 35 words that start anywhere else too; a document of which no word stays goes."""
    found = substrings.dedup(docs, layout=True).filter("n_removed < n_words OR n_words = 0")
    changed = found.withColumnRenamed("kept_text", "text")
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def without_benchmark(spark, docs, sf_dir):
    """Keep documents that hold no window of a benchmark item.

    Texts without words hold none and stay. Ids, null or repeated, and further columns play no part; an empty table of
    documents or items leaves nothing, or all.
    """
    return wumanber.find(docs, table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select(*docs.columns)


def tokens(spark, docs, sf_dir):
    """Encode every text; ids are little-endian unsigned 32-bit numbers, and decoded_sha256 tells what they decode to.

    The ids are written before they are decoded, so that a task does not hold the workers of both at once. A null or empty
    text has no ids; ids of documents, null or repeated, and further columns are carried along; an empty table stays empty.
    """
    tables = bpe.vocabulary(spark, queries.vocabulary_path())
    encoded = materialize(bpe.encode(docs, tables).drop("text"), "ids")
    decoded = bpe.decode(encoded, tables)
    return decoded.withColumn("decoded_sha256", F.sha2(F.encode("decoded", "UTF-8"), 256)).drop("decoded")


STAGES = [("quality", good_quality), ("near_duplicates", one_of_each_group), ("substrings", without_repeats),
          ("decontamination", without_benchmark), ("tokens", tokens)]

#: SQL cannot express the trained classifier and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
