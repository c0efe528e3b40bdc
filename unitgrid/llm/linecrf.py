"""Document quality from a linear-chain conditional random field over lines.

Every line gets a label, good or bad. Its features are shares of character classes and of words that repeat one just
before them, and its length, beside those of the line before and the line after; the chain adds weights for neighbouring labels. Forward-backward gives each
line's probability of being good; their mean, weighted by length, is the document's quality, which a logistic curve
turns into the probability of the label.

The field is fitted by the driver on a bounded sample of labelled documents: `sample` documents of at most
`longest` bytes, those with the least hash, so the sample does not depend on row order or partitions. Only documents carry
labels. Lines of good documents count as good; of a bad document those lines count as bad that a first
classifier finds bad, and always the worst one. Scoring reads every text where it lies, whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import Words, bytes_of, slices


def _class(*bytes_):
    out = np.zeros(256, np.uint8)
    out[list(bytes_)] = 1
    return out


CLASSES = np.stack([
    _class(*range(65, 91)), _class(*range(97, 123), *range(128, 256)), _class(*range(48, 58)), _class(32, 9, 11, 12, 13),
    _class(33), _class(124), _class(*b"#$%&*+/<=>@\\^_`{}~"), _class(*b".,;:?'\"()-[]"),
])
UPPER, LETTER, DIGIT, SPACE, SHOUT, PIPE, SYMBOL, POINT = range(8)


def lines_of(column):
    """(features of each line that shows anything, its length in bytes, lines of each text)."""
    buf, offsets = bytes_of(column)
    n = len(offsets) - 1
    if not len(buf):
        return np.zeros((0, 36)), np.zeros(0), np.zeros(n, np.int64)
    start = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(buf == 10) + 1]))
    start = start[start < len(buf)]
    counts = np.stack([np.add.reduceat(c[buf], start, dtype=np.int64) for c in CLASSES], axis=1).astype(float)
    length = np.diff(np.append(start, len(buf))).astype(float)
    shown = counts.sum(1) > counts[:, SPACE]
    text = np.searchsorted(offsets, start, "right") - 1
    spoken = Words(column)
    h, line_of = spoken.hashes(), np.searchsorted(start, spoken.start, "right") - 1
    repeats = np.zeros(len(h), bool)
    for k in (1, 2):
        repeats[k:] |= (h[k:] == h[:-k]) & (line_of[k:] == line_of[:-k])
    repeats = np.bincount(line_of[repeats], minlength=len(start))[shown]
    counts, length, text = counts[shown], length[shown], text[shown]
    letters = counts[:, UPPER] + counts[:, LETTER]
    words = counts[:, SPACE] + 1
    x = np.stack([
        counts[:, UPPER] / np.maximum(letters, 1), counts[:, UPPER] > 0.5 * letters, np.sqrt(counts[:, DIGIT] / length),
        np.sqrt(counts[:, SHOUT] / words), np.sqrt(counts[:, PIPE] / words), np.sqrt(counts[:, SYMBOL] / words),
        np.sqrt(counts[:, POINT] / words), np.log1p(length / words) / 4, np.log1p(length) / 8, letters < 0.5 * length,
        repeats / words, repeats > 0.3 * words], axis=1).astype(float)
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = text[1:] == text[:-1]
    before[1:][same], after[:-1][same] = x[:-1][same], x[1:][same]
    return np.concatenate([x, before, after], axis=1), length, np.bincount(text, minlength=n)


def forward_backward(emission, counts, step):
    """Probability of good for each line, and of (good, good) .. pairs in sum.

    emission: log weight of good against bad per line; counts: lines of each text; step: log weights [from, to] of
    neighbouring labels (0 bad, 1 good). All texts move on together, line by line.
    """
    m = len(emission)
    order = np.argsort(-counts, kind="stable")
    first, size = (np.cumsum(counts) - counts)[order], counts[order]
    longest = int(size[0]) if len(size) else 0
    alpha, beta = np.zeros((m, 2)), np.zeros((m, 2))
    e = np.stack([np.zeros(m), emission], axis=1)
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(longest + 1)]  # texts with more than t lines

    def log_sum(a):
        top = a.max(axis=1)
        return top + np.log(np.exp(a - top[:, None, :]).sum(axis=1))

    for t in range(longest):
        at = first[:alive[t]] + t
        alpha[at] = e[at] + (0 if t == 0 else log_sum(alpha[at - 1][:, :, None] + step[None]))
    for t in range(longest - 2, -1, -1):
        at = first[:alive[t + 1]] + t
        beta[at] = log_sum((step[None] + (e[at + 1] + beta[at + 1])[:, None, :]).transpose(0, 2, 1))
    both = alpha + beta
    norm = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - norm)
    inner = np.ones(m, bool)
    inner[(np.cumsum(counts) - 1)[counts > 0]] = False
    i = np.flatnonzero(inner)
    pair = np.exp(alpha[i][:, :, None] + step[None] + (e[i + 1] + beta[i + 1])[:, None, :] - norm[i][:, None, None]).sum(axis=0)
    return good, pair, i


def _descend(value, gradient, rounds, rate=0.1):
    """Adam on the mean log-likelihood's gradient."""
    first, second = np.zeros_like(value), np.zeros_like(value)
    for k in range(1, rounds + 1):
        g = gradient(value)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        value = value + rate * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.999 ** k)) + 1e-8)
    return value


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def document_quality(good, length, counts):
    """Length-weighted mean of the lines' probabilities; 0.5 for a text without lines."""
    text = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(text, weights=length, minlength=len(counts))
    total = np.bincount(text, weights=length * good, minlength=len(counts))
    return np.where(weight > 0, total / np.maximum(weight, 1e-9), 0.5)


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(texts, labels, rounds=100):
    """Model {weights, bias, step, curve} from texts and their 0/1 labels."""
    x, length, counts = lines_of(pa.array(texts, pa.string()))
    labels = np.asarray(labels)
    rate = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    d = x.shape[1]
    if len(set(labels.tolist())) < 2 or not len(x):
        return {"weights": np.zeros(d), "bias": 0.0, "step": np.zeros((2, 2)), "curve": np.array([_logit(rate), 0.0])}
    y = np.repeat(labels, counts).astype(float)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = _descend(np.zeros(d + 1), lambda v: design.T @ (share * (y - _sigmoid(design @ v))) - 1e-4 * v, rounds)
    score, text = design @ w, np.repeat(np.arange(len(counts)), counts)
    worst = np.full(len(counts), np.inf)
    np.minimum.at(worst, text, score)
    line = np.where((y == 0) & ((score < 0) | (score == worst[text])), 0.0, 1.0)
    inner = np.ones(len(x), bool)
    inner[(np.cumsum(counts) - 1)[counts > 0]] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (line[i].astype(int), line[i + 1].astype(int)), 1)

    def gradient(v):
        good, pair, _ = forward_backward(design @ v[:d + 1], counts, v[d + 1:].reshape(2, 2))
        return np.concatenate([design.T @ (line - good), (seen - pair).ravel()]) / len(x) - 1e-4 * v

    v = _descend(np.concatenate([w, np.zeros(4)]), gradient, rounds)
    step = v[d + 1:].reshape(2, 2)
    good, _, _ = forward_backward(design @ v[:d + 1], counts, step)
    z = np.stack([np.ones(len(counts)), _logit(document_quality(good, length, counts))], axis=1)
    curve = _descend(np.zeros(2), lambda c: z.T @ (labels - _sigmoid(z @ c)) / len(labels), 4 * rounds)
    return {"weights": v[:d], "bias": float(v[d]), "step": step, "curve": curve}


def score_texts(model, column):
    """(score, quality, lines, good lines) of each text."""
    x, length, counts = lines_of(column)
    good, _, _ = forward_backward(x @ model["weights"] + model["bias"], counts, model["step"])
    quality = document_quality(good, length, counts)
    score = _sigmoid(model["curve"][0] + model["curve"][1] * _logit(quality))
    text = np.repeat(np.arange(len(counts)), counts)
    return score, quality, counts, np.bincount(text[good >= 0.5], minlength=len(counts))


def scorer(model):
    def run(batches):
        for batch in slices(batches):
            out = score_texts(model.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *(pa.array(v, t) for v, t in zip(out, (pa.float64(), pa.float64(), pa.int64(), pa.int64())))],
                                             names=["row", "text", "score", "line_quality", "n_lines", "n_good_lines"])
    return run


def sample_of(docs, labels, label, id="doc_id", text="text", sample=4000, longest=50_000, with_ids=False):
    """(texts, labels): at most `sample` labelled documents, those whose id has the least hash; of texts with one id the least."""
    rows = labels.select(common.quoted(id).alias("id"), common.quoted(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    chosen = rows.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    got = (docs.select(common.quoted(id).alias("id"), common.quoted(text).alias("text")).filter(F.octet_length("text") <= longest)
           .join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect())
    got.sort(key=lambda r: r.id)
    texts, marks = [r.text for r in got], [r.label for r in got]
    return ([r.id for r in got], texts, marks) if with_ids else (texts, marks)


def train(docs, labels, label="quality", id="doc_id", text="text", sample=4000, longest=50_000):
    """Fit on a bounded sample and broadcast the model (a few hundred numbers)."""
    common.ship("unitgrid.llm.common", __name__)
    return docs.sparkSession.sparkContext.broadcast(fit(*sample_of(docs, labels, label, id, text, sample, longest)))


def score(docs, model, text="text"):
    """All columns of `docs` and: score (0 to 1), line_quality (the weighted mean before the curve), n_lines, n_good_lines.

    A text without a visible line (null, empty, white space) has line_quality 0.5 and the score of that value. A
    column of `docs` with one of the new names is replaced; repeated rows score alike; an empty table stays empty.
    """
    made = ("score", "line_quality", "n_lines", "n_good_lines")
    packed = docs.select(common.rest_struct(docs, text, *made).alias("row"), common.quoted(text).alias("text"))
    done = packed.mapInArrow(scorer(model), f"row {packed.schema['row'].dataType.simpleString()}, text string, score double, line_quality double, n_lines long, n_good_lines long")
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in common.others(docs, *made)], *made)
