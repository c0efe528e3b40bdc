"""Toxicity by the nearest labelled examples.

A text and the labelled examples are TF-IDF vectors over all terms (words, and beginnings of longer words); terms that tell the label
apart weigh `boost` times as much. Similarity is their exact cosine; terms that no example holds count in a text's length. The examples lie in an inverted index with block maxima: the examples of a term are cut into blocks, and of each
block the largest weight is stored. The lists of terms that many examples hold are rows of a matrix, whose product
with a query is exact. A query adds the block maxima of its other terms, and opens the blocks whose bound reaches the k-th best exact
part, below which no neighbour can lie; so the k nearest are exact. Their labels
vote with weights that fall with distance, a logistic curve fitted leave-one-out turns votes into probabilities, and
the nearest examples are returned as evidence.

The examples are a bounded sample of the labelled documents (`sample`, texts of at most `longest` bytes, least hash
of the id first), and so are the terms that weigh more (at most `terms`). All terms of the sample are indexed and broadcast. Texts are scored where they lie, whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.linecrf import _descend, _sigmoid, sample_of
from unitgrid.llm.textpack import BASE, BYTE_HASH, NOT_ALNUM, Words, mixed, powers, slices

BLOCK = 64
LEAST_TEXTS = 8
BOOST = 2.0  # weight of a term that tells the label apart, times that of others; chosen by `choose_boost` on a training fold
STEMS = (4, 5, 6, 7, 8)  # bytes of a word's beginning
EVIDENCE = "array<struct<id:string,label:int,similarity:double>>"


def _terms(column):
    """Occurrences of terms: (text, hash, word index, bytes of the word that make the term, or 0 for the whole word), and the words."""
    words = Words(column, NOT_ALNUM, lower=True)
    text_of, every = words.text_of_word().astype(np.int32), np.arange(len(words.start), dtype=np.int32)
    text, value, word, size = [text_of], [words.hashes()], [every], [np.zeros(len(every), np.int8)]
    total, power = np.zeros(len(every), np.uint64), powers(BASE, max(STEMS))
    with np.errstate(over="ignore"):
        for j in range(max(STEMS)):
            every = every[words.lengths[every] > j + 1]  # shorter than the word
            total[every] += BYTE_HASH[words.buf[words.start[every] + j]] * power[j]
            if j + 1 in STEMS:
                text.append(text_of[every])
                value.append(mixed(total[every], 100 + j))
                word.append(every)
                size.append(np.full(len(every), j + 1, np.int8))
    return [np.concatenate(x) for x in (text, value, word, size)] + [words]


def ragged(start, size):
    """start[0], start[0] + 1, ... of `size[0]` numbers, then those of start[1], and so on."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _table(columns):
    """Terms and their occurrences in several columns of texts: (hashes, sizes, spelling of whole words, (row, term, times) ordered by row)."""
    kinds, sizes, spans, spelled, rows, values, times, done = [], [], [], [], [], [], [], 0
    for column in columns:
        text, value, word, size, words = _terms(column)
        kind, first, number = np.unique(value, return_index=True, return_inverse=True)
        span = np.where(size[first] == 0, words.lengths[word[first]], 0)
        key, n = np.unique(text.astype(np.int64) * len(kind) + number, return_counts=True)
        kinds, sizes, spans = kinds + [kind], sizes + [size[first]], spans + [span]
        spelled.append(words.buf[ragged(words.start[word[first]], span)])
        rows, values, times = rows + [(key // max(1, len(kind)) + done).astype(np.int32)], values + [kind[key % max(1, len(kind))]], times + [n.astype(np.int32)]
        done += words.texts
    whole, first = np.unique(np.concatenate([*kinds, np.zeros(0, np.uint64)]), return_index=True)
    span, data = np.concatenate([*spans, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*spelled, np.zeros(0, np.uint8)])
    data = data[ragged((np.cumsum(span) - span)[first], span[first])]
    term = np.searchsorted(whole, np.concatenate([*values, np.zeros(0, np.uint64)])).astype(np.int32)
    return whole, np.concatenate([*sizes, np.zeros(0, np.int8)])[first], (span[first], data), (np.concatenate([*rows, np.zeros(0, np.int32)]), term, np.concatenate([*times, np.zeros(0, np.int32)]))


def _found(model, value, word, size, words):
    """Term of each occurrence, -1 if it is none. The hash finds the term, size and spelling decide (the hash of a beginning is its bytes')."""
    if not len(model["hash"]):
        return np.full(len(value), -1)
    at = np.minimum(np.searchsorted(model["hash"], value), len(model["hash"]) - 1)
    good = (model["hash"][at] == value) & (model["sizes"][at] == size)
    span, data = model["spelling"]
    whole = np.flatnonzero(good & (size == 0))
    good[whole] = span[at[whole]] == words.lengths[word[whole]]
    whole = whole[good[whole]]
    if len(whole):
        length = span[at[whole]]
        same = data[ragged((np.cumsum(span) - span)[at[whole]], length)] == words.buf[ragged(words.start[word[whole]], length)]
        good[whole] = np.logical_and.reduceat(same, np.cumsum(length) - length)
    return np.where(good, at, -1)


def choose_terms(t, w, n_terms, tests, labels, most, least_texts=LEAST_TEXTS, error=0.05):
    """Terms whose presence depends on the label, the strongest `most`.

    A term must be in `least_texts` examples and pass a chi-square test at `error` divided by the number of `tests`
    (tail bounded by exp(-x / 2)), so that chance hits among many rare terms are left out. (t, w) are the distinct pairs of an example and a term.
    """
    n, pos = len(labels), labels.sum()
    df = np.bincount(w, minlength=n_terms).astype(float)
    hit = np.bincount(w, weights=labels[t], minlength=n_terms)
    a, b, c, d = hit, df - hit, pos - hit, (n - pos) - (df - hit)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = n * (np.abs(a * d - b * c) - n / 2).clip(0) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    score = np.nan_to_num(score)
    ok = np.flatnonzero((df >= least_texts) & (score >= 2 * np.log(tests / error)))
    ok = ok[np.lexsort((ok, -score[ok]))][:most]
    return ok, df


def vectors(row, column, times, n_rows, idf):
    """Weights of sparse unit TF-IDF vectors from distinct (row, column) pairs and how often they occur."""
    weight = (1 + np.log(times)) * idf[column]
    norm = np.sqrt(np.bincount(row, weights=weight ** 2, minlength=n_rows))
    return weight / norm[row] if len(row) else weight


class Index:
    """Block-max inverted index of unit vectors: each term's examples with weights, cut into blocks, and each block's maximum.

    Lists of terms that many examples hold are full rows of a matrix; its product with a query is their exact part of the cosines,
    and the largest of a block joins the block's bound.
    """

    def __init__(self, row, column, weight, n_terms, n_rows):
        order = np.lexsort((row, column))
        row, weight, column = np.asarray(row)[order].astype(np.int32), np.asarray(weight)[order], np.asarray(column)[order].astype(np.int64)
        self.blocks = -(-max(n_rows, 1) // BLOCK)
        df = np.bincount(column, minlength=n_terms)
        heavy = np.flatnonzero(df >= max(BLOCK, n_rows // 16))
        self.full = np.full(n_terms, -1, np.int32)
        self.full[heavy] = np.arange(len(heavy))
        self.matrix = np.zeros((len(heavy), self.blocks * BLOCK))
        at = self.full[column]
        self.matrix[at[at >= 0], row[at >= 0]] = weight[at >= 0]
        self.row, self.weight, column = row[at < 0], weight[at < 0], column[at < 0]
        key = column * self.blocks + self.row // BLOCK
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.at, self.block = np.append(at, len(key)), (key[at] % self.blocks).astype(np.int32)
        self.tops = np.maximum.reduceat(self.weight, at) if len(at) else np.zeros(0)
        self.lists = np.searchsorted(column[at], np.arange(n_terms + 1))

    def search(self, row, column, weight, n_rows, k, leave=False, at_once=128):
        """For each query with terms (ordered by row): (its number, examples, cosines); with `leave` query i is example i and not its own neighbour."""
        cut = np.searchsorted(row, np.arange(n_rows + 1))
        for i in range(0, n_rows, at_once):
            j = min(i + at_once, n_rows)
            here = np.arange(cut[i], cut[j])
            here = here[self.full[column[here]] >= 0]
            queries = np.zeros((j - i, len(self.matrix)))
            queries[row[here] - i, self.full[column[here]]] = weight[here]
            exact = queries @ self.matrix
            for q in range(i, j):
                a, b = cut[q], cut[q + 1]
                if b > a:
                    yield q, *self.nearest(column[a:b], weight[a:b], k, q if leave else -1, exact[q - i])

    def nearest(self, terms, values, k, skip=-1, exact=None):
        """(examples, cosines) of the k nearest with a positive cosine; ties go to the example of less number. `exact`: the matrix' part."""
        full = self.full[terms]
        if exact is None:
            exact = values[full >= 0] @ self.matrix[full[full >= 0]]
        terms, values, exact = terms[full < 0], values[full < 0], exact.reshape(self.blocks, BLOCK)
        size = self.lists[terms + 1] - self.lists[terms]
        part, value = ragged(self.lists[terms], size), np.repeat(values, size)
        bound = exact.max(axis=1) + np.bincount(self.block[part], weights=value * self.tops[part], minlength=self.blocks)
        floor, skipped = exact.ravel().copy(), np.arange(self.blocks * BLOCK) == skip
        floor[skipped] = 0.0
        # every cosine is at least its exact part: blocks below the k-th best of these hold no neighbour
        floor = max(0.0, np.partition(floor, -k)[-k]) if len(floor) >= k else 0.0
        opens = bound >= floor - 1e-12
        inside = opens[self.block[part]]
        part, value = part[inside], value[inside]
        size = self.at[part + 1] - self.at[part]
        every = ragged(self.at[part], size)
        got = exact.ravel() + np.bincount(self.row[every], weights=np.repeat(value, size) * self.weight[every], minlength=self.blocks * BLOCK)
        ids = np.flatnonzero((got >= max(floor - 1e-12, 1e-300)) & np.repeat(opens, BLOCK) & ~skipped)
        sims = got[ids]
        if len(ids) > k:
            near = sims >= np.partition(sims, -k)[-k] - 1e-11
            ids, sims = ids[near], sims[near]
        best = np.lexsort((ids, -np.round(sims, 12)))[:k]
        return ids[best], sims[best]


def vote(labels, ids, sims):
    """Share of label 1 among the neighbours, each weighted by 1 / (distance + 0.05), and how many there are."""
    w = 1 / (np.sqrt(np.maximum(0, 2 - 2 * sims)) + 0.05)
    return float((w * labels[ids]).sum() / w.sum())


def fit(ids, texts, labels, k=15, terms=512, boost=BOOST):
    """Plain tables of a classifier: terms, their weights, the index's vectors, labels, ids, and the curve."""
    labels = np.asarray(labels, dtype=float)
    rate = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    kinds, sizes, spelling, (row, column, times) = _table(pa.array(texts[i:i + 250], pa.string()) for i in range(0, len(texts), 250))
    df = np.bincount(column, minlength=len(kinds))
    idf = np.log((1 + len(texts)) / (1 + df)) + 1
    if len(kinds) and 0 < labels.sum() < len(labels):
        held = df[column] >= LEAST_TEXTS
        idf[choose_terms(row[held], column[held], len(kinds), len(kinds), labels, terms)[0]] *= boost
    weight = vectors(row, column, times, len(texts), idf)
    index = Index(row, column, weight, len(kinds), len(texts))
    none = np.ones(len(texts), bool)
    none[row] = False
    base = float((labels[none].sum() + rate) / (none.sum() + 1)) if len(labels) else rate
    share, truth = [], []
    for i, near, sims in index.search(row, column, weight, len(texts), k, leave=True):
        share.append(vote(labels, near, sims) if len(near) else base)
        truth.append(labels[i])
    z = np.stack([np.ones(len(share)), 2 * np.array(share) - 1], axis=1) if share else np.zeros((0, 2))
    curve = _descend(np.zeros(2), lambda c: z.T @ (np.array(truth) - _sigmoid(z @ c)) / len(z) - 1e-4 * c, 600) if share else np.zeros(2)
    return {"hash": kinds, "sizes": sizes, "spelling": spelling, "idf": idf, "unseen": float(np.log(1 + len(texts)) + 1), "vectors": (row, column, weight), "labels": labels,
            "ids": [str(i) for i in ids], "base": base, "curve": curve, "k": k}


def leave_one_out(model):
    """Mean log loss of the examples' own labels, each scored by the others. Only the examples are looked at."""
    row, column, weight = model["vectors"]
    labels, n = model["labels"], len(model["labels"])
    index, p = Index(row, column, weight, len(model["idf"]), n), np.full(n, model["base"])
    for i, near, sims in index.search(row, column, weight, n, model["k"], leave=True):
        if len(near):
            p[i] = _sigmoid(model["curve"][0] + model["curve"][1] * (2 * vote(labels, near, sims) - 1))
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return float(-np.log(np.where(labels == 1, p, 1 - p)).mean()) if n else 0.0


def choose_boost(ids, texts, labels, candidates=(1.0, 2.0, 4.0, 8.0), k=15, terms=512):
    """(the candidate of least leave-one-out loss, the least of equal ones; the loss of each)."""
    losses = {b: leave_one_out(fit(ids, texts, labels, k, terms, b)) for b in candidates}
    return min(candidates, key=lambda b: (losses[b], b)), losses


def score_texts(model, index, column):
    """(score, evidence) of each text."""
    text, value, word, size, words = _terms(column)
    term = _found(model, value, word, size, words)
    n = len(model["idf"])
    key, times = np.unique(text[term >= 0].astype(np.int64) * max(1, n) + term[term >= 0], return_counts=True)
    row, column = key // max(1, n), key % max(1, n)
    # terms of no example: they meet nothing, but lengthen the text's vector
    kinds, number = np.unique(value[term < 0], return_inverse=True)
    other, often = np.unique(text[term < 0].astype(np.int64) * max(1, len(kinds)) + number, return_counts=True)
    weight = (1 + np.log(times)) * model["idf"][column]
    norm = np.sqrt(np.bincount(row, weights=weight ** 2, minlength=words.texts)
                   + np.bincount(other // max(1, len(kinds)), weights=((1 + np.log(often)) * model["unseen"]) ** 2, minlength=words.texts))
    weight = weight / norm[row]
    score, evidence = np.full(words.texts, model["base"]), [[] for _ in range(words.texts)]
    for i, near, sims in index.search(row, column, weight, words.texts, model["k"]):
        if len(near):
            score[i] = _sigmoid(model["curve"][0] + model["curve"][1] * (2 * vote(model["labels"], near, sims) - 1))
            evidence[i] = [{"id": model["ids"][j], "label": int(model["labels"][j]), "similarity": float(s)} for j, s in zip(near[:3].tolist(), sims[:3].tolist())]
    return score, evidence


def scorer(shared):
    def run(batches):
        model = shared.value
        index = Index(*model["vectors"], len(model["idf"]), len(model["labels"]))
        for batch in slices(batches, 2_000_000):
            score, evidence = score_texts(model, index, batch.column("text"))
            kind = pa.list_(pa.struct([("id", pa.string()), ("label", pa.int32()), ("similarity", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(score), pa.array(evidence, kind)], names=["row", "text", "score", "evidence"])
    return run


def train(docs, labels, label="toxic", id="doc_id", text="text", sample=4000, longest=50_000, k=15, terms=512, boost=BOOST):
    """Fit on a bounded sample of labelled documents and broadcast the tables (one weight for each distinct term of an example)."""
    common.ship("unitgrid.llm.common", "unitgrid.llm.linecrf", __name__)
    ids, texts, marks = sample_of(docs, labels, label, id, text, sample, longest, with_ids=True)
    return docs.sparkSession.sparkContext.broadcast(fit(ids, texts, marks, k, terms, boost))


def score(docs, model, text="text"):
    """All columns of `docs` and: score (0 to 1), evidence (the three nearest examples: id, label, similarity).

    A text that shares no term with an example (null and empty ones too) has no neighbour: its score is the share of label 1
    among examples without a term, its evidence empty. Repeated rows score alike, an example that is scored finds itself; a column of `docs`
    with one of the new names is replaced; an empty table stays empty.
    """
    made = ("score", "evidence")
    packed = docs.select(common.rest_struct(docs, text, *made).alias("row"), common.quoted(text).alias("text"))
    done = packed.mapInArrow(scorer(model), f"row {packed.schema['row'].dataType.simpleString()}, text string, score double, evidence {EVIDENCE}")
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in common.others(docs, *made)], *made)
