"""Language of web pages by Bayesian evidence fusion.

log posterior(language) = log prior(language | host) + log likelihood(text) + log P(declared markup language | language)
+ log P(address suffix | language) + log P(path language | language), normalized over the languages.

- Text: character trigrams, multinomial, add-half smoothed, learned from labelled texts (a bounded sample).
- Host priors: shrunken in steps, world -> last host label -> registered domain -> host: each level's counts of first
  guesses (by text alone) with the level above as `strength` pseudo-counts. Counts are grouped sums over all pages; a
  host with a third of all pages is one row of partial sums for each task.
- Markup, suffix (the host's last label) and path tables: P(value | language) from the same grouped sums, add-one smoothed, so a
  declaration weighs as much as it agrees with the texts here. The last label is a level of the host priors too: these speak
  for hosts, the table for pages.
"""

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.maintext import TOKEN, blocks_of
from unitgrid.llm.textpack import slices
from unitgrid.session import materialize

LETTERS = re.compile(r"[^\W\d_]+")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)
META = re.compile(r"<meta\b[^>]*?(?:content-language|og:locale)[\"'][^>]*?content\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)
HASH_BITS = 16


def trigrams(text):
    """Hashed trigram numbers of the words of a text, each word between blanks."""
    joined = " " + " ".join(LETTERS.findall(text.lower())) + " "
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(code) < 3:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        x = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) ^ code[2:]
        x = x * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def fit_text(texts, labels):
    """Trigram model: languages in order, log probabilities (language x trigram)."""
    languages = sorted(set(labels))
    counts = np.full((len(languages), 1 << HASH_BITS), 0.5)
    for text, label in zip(texts, labels):
        counts[languages.index(label)] += np.bincount(trigrams(text or ""), minlength=1 << HASH_BITS)
    if not languages:
        return {"languages": [], "log": np.zeros((0, 1 << HASH_BITS), np.float32)}
    return {"languages": languages, "log": (np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))).astype(np.float32)}


def page_evidence(page):
    """(visible text, declared language or "") of a page."""
    page = page or ""
    found = DECLARED.search(page) or META.search(page)
    return "\n".join(b[0] for b in blocks_of(page) if not b[2]), found[1].lower() if found else ""


def reader(shared):
    def run(batches):
        model = shared.value
        for batch in slices(batches, 4_000_000, "html"):
            declared, scores = [], []
            for page in batch.column("html").to_pylist():
                text, code = page_evidence(page)
                declared.append(code)
                # trigrams of a text depend on each other: evidence grows with the root of their number
                t = trigrams(text)
                scores.append((model["log"][:, t].sum(axis=1) / max(1.0, np.sqrt(len(t)))).astype(float) if len(t) and model["languages"] else np.zeros(len(model["languages"])))
            best = [int(np.argmax(s)) if len(s) and s.any() else -1 for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(declared), pa.array([s.tolist() for s in scores], pa.list_(pa.float64())),
                                              pa.array([model["languages"][b] if b >= 0 else None for b in best], pa.string())],
                                             names=["row", "declared", "likelihood", "guess"])
    return run


def train(docs, labels_column="lang", text="text", id="doc_id", sample=2000, longest=50_000):
    """Trigram model from a bounded sample of labelled texts; broadcast.

    Every language has an equal share of the sample (one text at least), its texts with the least hash of the id; of rows with one id the
    least (label, text) counts. Without a labelled text the model has no language.
    """
    common.ship("unitgrid.llm.common", "unitgrid.llm.maintext", __name__)
    rows = (docs.select(common.quoted(id).alias("id"), common.quoted(text).alias("text"), common.quoted(labels_column).alias("label"))
            .filter(F.col("label").isNotNull() & F.col("id").isNotNull() & (F.octet_length("text") <= longest)))
    # ids are chosen first, so that texts other than the sample's never move
    kinds = [r.label for r in rows.select("label").distinct().orderBy("label").limit(sample).collect()]
    ids = rows.groupBy("id").agg(F.min("label").alias("label"))
    parts = [ids.filter(F.col("label") == x).orderBy(F.xxhash64("id"), "id").limit(max(1, sample // len(kinds))) for x in kinds]
    if parts:
        rows = rows.join(reduce(DataFrame.unionByName, parts), ["id", "label"]).groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    else:
        rows = []
    rows.sort(key=lambda r: r.id)
    return docs.sparkSession.sparkContext.broadcast(fit_text([r.text for r in rows], [r.label for r in rows]))


def _address(url):
    """host, registered domain (two last labels), last label, and path language (a two-letter first path part)."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".")
    last = F.element_at(labels, -1)
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return {"host": host, "domain": domain, "last": last, "path": path}


def _shrunk(counts, key, above, languages, strength):
    """Distribution of each `key`: its counts with the level above as `strength` pseudo-counts."""
    total = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    return counts.select(key, *[c for c in counts.columns if c not in (key, "counts", "above")],
                         F.zip_with("counts", "above", lambda c, p: (c + strength * p) / (total + strength)).alias(key + "_prior"))


def identify(pages, model, html="html", url="url", strength=10.0):
    """The other columns of `pages` and: lang, confidence (its posterior), declared, suffix, text_lang.

    A null or empty page has no text evidence, a page without a declaration or a null address none of that kind; with no evidence
    at all the prior of the world decides; ties go to the language first in order. Repeated rows count as pages. An
    empty table gives an empty one; a column of `pages` with one of the new names is replaced. `suffix` is the host's last label ("" if there
    is no host), `path_lang` the two-letter first path part. With a model of no language lang, confidence and text_lang are NULL.
    """
    languages = model.value["languages"]
    made = ("lang", "confidence", "declared", "suffix", "path_lang", "text_lang")
    rest = common.rest_struct(pages, html, *made)
    packed = pages.select(F.struct(rest.alias("rest"), *[e.alias(n) for n, e in _address(F.coalesce(common.quoted(url), F.lit(""))).items()]).alias("row"), common.quoted(html).alias("html"))
    read = packed.mapInArrow(reader(model), f"row {packed.schema['row'].dataType.simpleString()}, declared string, likelihood array<double>, guess string")
    if not languages:
        address = read.select("row.*", "declared")
        return address.select(*[F.col("rest").getField(c).alias(c) for c in common.others(pages, html, *made)], F.lit(None).cast("string").alias("lang"),
                              F.lit(None).cast("double").alias("confidence"), "declared", F.col("last").alias("suffix"), F.col("path").alias("path_lang"),
                              F.lit(None).cast("string").alias("text_lang"))
    read = materialize(read.select("row.*", "declared", "likelihood", "guess"), "evidence")
    one = F.array(*[(F.col("guess") == x).cast("double") for x in languages])
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.array(*[F.coalesce(F.sum((F.col("guess") == x).cast("double")), F.lit(0.0)) for x in languages]).alias("counts"))
    hosts = materialize(sums(read, "host", "domain", "last"), "hosts")

    def level(*keys):
        return hosts.groupBy(*keys).agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(len(languages))]).alias("counts"))

    n = len(languages)
    world = [c or 0.0 for c in level().first().counts]
    world = [(c + 1.0) / (sum(world) + n) for c in world]
    last = _shrunk(level("last").withColumn("above", F.array(*[F.lit(w) for w in world])), "last", None, n, strength)
    domain = _shrunk(level("domain", "last").join(last, "last").withColumnRenamed("last_prior", "above"), "domain", None, n, strength)
    host = _shrunk(hosts.join(domain, ["domain", "last"]).withColumnRenamed("domain_prior", "above"), "host", None, n, strength).select("host", "host_prior")

    def table_of(key):
        """log P(value | language) of a declaration, suffix or path; its rows are the distinct values."""
        counts = sums(read.filter(F.col(key) != ""), key)
        whole = counts.agg(F.count(F.lit(1)).alias("kinds"), F.array(*[F.coalesce(F.sum(F.col("counts")[i]), F.lit(0.0)) for i in range(n)]).alias("whole"))
        return counts.join(whole).select(key, F.zip_with("counts", "whole", lambda c, w: F.log((c + 1) / (w + F.col("kinds") + 1))).alias(key + "_log"))

    nothing = F.array(*[F.lit(0.0)] * n)
    joined = read
    for key in ("declared", "last", "path"):
        joined = joined.join(table_of(key), key, "left").withColumn(key + "_log", F.coalesce(key + "_log", nothing))
    joined = joined.join(host, "host", "left")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(F.transform("host_prior", lambda p: F.log(p)), F.col("likelihood")), add(F.col("declared_log"), add(F.col("last_log"), F.col("path_log"))))
    ranked = joined.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    weights = ranked.withColumn("weights", F.transform("logs", lambda x: F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(x) for x in languages])
    out = weights.select(
        *[F.col("rest").getField(c).alias(c) for c in common.others(pages, html, *made)],
        F.element_at(names, F.array_position("logs", F.col("top")).cast("int")).alias("lang"),
        (1.0 / F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)).alias("confidence"), "declared", F.col("last").alias("suffix"), F.col("path").alias("path_lang"), F.col("guess").alias("text_lang"))
    return out
