"""Exact substring dedup: words covered by a window of words that starts anywhere else are removed.

Method: fixed-block anchors. Every text is cut into non-overlapping blocks of `(window + 1) // 2` words, so each
window holds one whole block of its own text. Blocks are indexed by hash; every rolling window of block length,
in all texts, probes the index. A block that some other position repeats is a hit, and only the windows around
hits are looked at further: they are compared on a wider hash, and consecutive repeated windows form the maximal
exact repeats, whose words go.

A block of a text and a window elsewhere that repeats it may be two of thousands. Nothing is paired: keys are
counted in buckets (`ballots`), each batch of texts sending a key once, so no copy group meets in one task.

The texts are shuffled once, into batches of bounded size; the shuffle is read three times (probe, compare,
remove). A window is compared on 64 bits of one hash and the bucket number of another, after its block matched on
32 bits and a bucket number of a third.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import ballots, common
from unitgrid.llm.textpack import Words, member, mixed, release, strings, window_hashes

HITS, REPEATS = 1, 2
LOW32 = np.uint64(0xFFFFFFFF)


def _bucket(h, buckets):
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _blocks(words, h, size, buckets):
    """Rolling block-length windows of a batch: (bucket, 32-bit key, is an indexed block, word index)."""
    at = np.flatnonzero(words.has_window(size))
    rolled = window_hashes(h, size)[at] if len(at) else np.zeros(0, np.uint64)
    indexed = (at - np.repeat(words.first[:-1], words.counts)[at]) % size == 0
    return _bucket(rolled, buckets), (rolled & LOW32).astype(np.uint32), indexed, at


def _around_hits(words, h, window, buckets, answers):
    """Word indices of the windows that hold an indexed block which occurs elsewhere."""
    size = (window + 1) // 2
    bucket, key, indexed, at = _blocks(words, h, size, buckets)
    hits = ballots.Keys(bucket, key, indexed)
    yes = hits.answered(answers)
    code = lambda b, k: (b.astype(np.uint64) << np.uint64(32)) | k.astype(np.uint64)
    wanted = np.sort(code(hits.bucket[yes], hits.key[yes]))
    block = at[indexed]
    block = block[member(code(bucket[indexed], key[indexed]), wanted)]
    change = np.zeros(len(h) + 1, np.int64)
    np.add.at(change, np.maximum(block - (window - size), 0), 1)
    np.add.at(change, block + 1, -1)
    return np.flatnonzero((np.cumsum(change[:-1]) > 0) & words.has_window(window))


def _wide(h, window, start, buckets):
    """(bucket, 64-bit key) of the windows that start at these words; two independent hashes."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    key = window_hashes(h, window, 0xE7037ED1A0B428DB, 2)[start]
    other = window_hashes(mixed(h, 11), window, 0x8EBC6AF09C88C6E3, 3)[start]
    return _bucket(other, buckets), key


def probe(text, window, buckets):
    def run(table):
        release()
        words = Words(table.column(text))
        bucket, key, indexed, _ = _blocks(words, words.hashes(), (window + 1) // 2, buckets)
        return ballots.Keys(bucket, key, indexed).rows(table.column("batch")[0].as_py())
    return run


def compare(text, window, buckets):
    def run(table, answers):
        release()
        words = Words(table.column(text)) if table.num_rows else Words(pa.array([], pa.string()))
        h = words.hashes()
        start = _around_hits(words, h, window, buckets, ballots.by_kind(answers, HITS))
        return ballots.Keys(*_wide(h, window, start, buckets)).rows(table.column("batch")[0].as_py() if table.num_rows else 0)
    return run


def remove(text, window, buckets, layout):
    def run(table, answers):
        release()
        words = Words(table.column(text)) if table.num_rows else Words(pa.array([], pa.string()))
        h = words.hashes()
        start = _around_hits(words, h, window, buckets, ballots.by_kind(answers, HITS))
        bucket, key = _wide(h, window, start, buckets)
        keys = ballots.Keys(bucket, key)
        yes = keys.answered(ballots.by_kind(answers, REPEATS))
        code = lambda b, k: mixed(k) ^ mixed(b.astype(np.uint64), 5)  # noqa: E731  only within this batch
        start = start[member(code(bucket, key), np.sort(code(keys.bucket[yes], keys.key[yes])))]
        change = np.zeros(len(h) + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        # maximal repeats: runs of removed words inside one text
        text_of = words.text_of_word()
        edge = np.ones(len(gone), bool)
        edge[1:] = (gone[1:] != gone[:-1]) | (text_of[1:] != text_of[:-1])
        at = np.flatnonzero(edge)
        to = np.append(at[1:], len(gone))
        at, to = at[gone[at]], to[gone[at]]
        owner = text_of[at]
        spans = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words.texts))]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(at - words.first[owner], pa.int64()), pa.array(to - words.first[owner], pa.int64())],
                                       ["from", "to"]))
        removed = np.bincount(text_of[gone], minlength=words.texts)
        return pa.table([table.column("row").combine_chunks(), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), spans,
                         _cut(words, gone) if layout else words.joined(~gone)], names=["row", "n_words", "n_removed", "spans", "kept_text"])
    return run


def _cut(words, gone):
    """The texts without the removed words and the white space behind them; the rest as it was."""
    n = len(words.buf)
    after = np.append(words.start[1:], n)  # where the next word, or the next text, starts
    after = np.minimum(after, np.repeat(words.offsets[1:], words.counts))
    change = np.zeros(n + 1, np.int8)  # a removed word starts where the one before it ends, or later
    np.add.at(change, words.start[gone], 1)
    np.add.at(change, after[gone], -1)
    keep = np.cumsum(change[:-1], dtype=np.int8) == 0
    sizes = np.array([np.count_nonzero(keep[a:b]) for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())], np.int64)
    return strings(words.buf[keep], np.concatenate([[0], np.cumsum(sizes)]))


def dedup(docs, text="text", window=35, layout=False):
    """Remove the words of every repeated window of `window` words.

    Returns the other columns of `docs` and: n_words, n_removed (long), spans (removed words as [from, to) word
    ranges, maximal), kept_text (the words that stay, joined by one space; with `layout` the text as
    it was without the removed words and the white space behind each). A column of `docs` with one of these
    names is replaced. Words are runs of bytes other than ASCII white space, unchanged. A null or empty text has no
    words, n_removed 0 and kept_text "". Repeated rows are texts like any other: each is the other's repeat. An
    empty table gives an empty one. Batches hold about 2 MB of text each.
    """
    common.ship("unitgrid.llm.ballots", __name__)
    spark = docs.sparkSession
    parts = common.partitions(spark)
    batches, buckets = common.portions(docs, text)
    made = ("n_words", "n_removed", "spans", "kept_text")
    row = common.rest_struct(docs, text, *made)
    packed = docs.select(
        F.pmod(F.xxhash64(common.quoted(text), *[common.quoted(c) for c in common.others(docs, text, *made) if dict(docs.dtypes)[c] in ("bigint", "int", "string")]),
               F.lit(batches)).cast("int").alias("batch"),
        row.alias("row"), common.quoted(text).alias("text")).repartition(parts, "batch")
    hits = (packed.groupBy("batch").applyInArrow(probe("text", window, buckets), ballots.SENT)
            .groupBy("bucket").applyInArrow(ballots.judge(HITS, np.uint32, True), ballots.ANSWER))
    repeats = (packed.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(compare("text", window, buckets), ballots.SENT)
               .groupBy("bucket").applyInArrow(ballots.judge(REPEATS, np.uint64, False), ballots.ANSWER))
    out = packed.schema["row"].dataType.simpleString()
    done = packed.groupBy("batch").cogroup(hits.unionByName(repeats).groupBy("batch")).applyInArrow(
        remove("text", window, buckets, layout), f"row {out}, n_words long, n_removed long, spans array<struct<from:long,to:long>>, kept_text string")
    keep = common.others(docs, text, *made)
    return done.select(*[F.col("row").getField(c).alias(c) for c in keep], *made)
