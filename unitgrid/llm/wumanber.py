"""Benchmark decontamination: which words of a text lie inside a window of a benchmark item?

Method: Wu-Manber multi-pattern search, with words as the symbols. The distinct windows of the items are the test
strings. Of every pair of neighbouring words (the block) a shift table says how far a search window that ends with
it can move on without missing a test string; most positions are skipped. Where the shift is zero, the bucket of
the block's hash (and of the first block's) selects test strings, and their bytes are compared directly.

Texts are searched where they lie, without a shuffle. The test strings are a stated query set: the items go to the
executors in blocks of bounded size, each measured before it is broadcast; a larger benchmark has more blocks, not larger
ones. A pass over the texts holds the blocks of `pass_mb` MB of items; what further passes find is united with what the
passes before them wrote, so neither driver nor executors ever hold more than the blocks of one pass. Inside a task the search windows of many segments move on together as one array.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import NOT_ALNUM, Words, mixed, release, slices
from unitgrid.session import materialize

SEGMENT = 512  # search windows of one segment
SHIFTS = np.uint64(0x2545F4914F6CDD1D)


def _pair(a, b):
    with np.errstate(over="ignore"):
        return mixed(a * SHIFTS + b, 3)


class Patterns:
    """Shift table and buckets of the test strings of one length (in words)."""

    def __init__(self, m, hashes, strings, owners):
        """hashes: (test strings, m) word hashes; strings: their words joined by a space; owners: ids of each."""
        self.m, self.strings, self.owners = m, strings, owners
        self.block = min(2, m)
        blocks = _pair(hashes[:, :-1], hashes[:, 1:]) if m > 1 else hashes
        farthest = m - self.block + 1
        bits = int(np.clip(np.ceil(np.log2(4 * blocks.size + 1)), 12, 24))
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, min(farthest, 255), np.uint8)
        for j in range(blocks.shape[1]):
            np.minimum.at(self.shift, (blocks[:, j] & self.mask).astype(np.int64), np.uint8(min(blocks.shape[1] - 1 - j, 255)))
        bucket = mixed(blocks[:, -1], 5) ^ blocks[:, 0]
        order = np.argsort(bucket, kind="stable")
        self.order, self.bucket = order, bucket[order]

    @classmethod
    def of(cls, state):
        """From the plain values that are broadcast."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def search(self, words, h):
        """(word index, test string) of every occurrence."""
        m, counts = self.m, words.counts
        windows = np.maximum(counts - m + 1, 0)
        pieces = -(-windows // SEGMENT)
        text = np.repeat(np.arange(words.texts), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = words.first[:-1][text] + nth * SEGMENT + m - 1  # last word of the search window
        to = np.minimum(at + SEGMENT, words.first[1:][text])
        ends = []
        while len(at):
            block = _pair(h[at - 1], h[at]) if self.block == 2 else h[at]
            shift = self.shift[(block & self.mask).astype(np.int64)].astype(np.int64)
            if not shift.all():
                ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            left = at < to
            at, to = at[left], to[left]
        if not ends:
            return []
        end = np.concatenate(ends)
        first = end - m + 1
        last = _pair(h[end - 1], h[end]) if self.block == 2 else h[end]
        head = _pair(h[first], h[first + 1]) if self.block == 2 else h[first]
        bucket = mixed(last, 5) ^ head
        low, high = np.searchsorted(self.bucket, bucket), np.searchsorted(self.bucket, bucket, "right")
        some, found, buf = np.flatnonzero(high > low), [], words.buf
        for i in some.tolist():
            a = int(first[i])
            here = b" ".join(buf[words.start[k]:words.end[k]].tobytes() for k in range(a, a + m))
            found += [(a, p) for p in self.order[low[i]:high[i]].tolist() if self.strings[p] == here]
        return found


def build(items, window):
    """Search tables for (id or None, text) items: a list of Patterns, one for each length that occurs."""
    words = Words(pa.array([t for _, t in items], pa.string()), NOT_ALNUM, lower=True)
    h, by_length = words.hashes(), {}
    for i, (item, _) in enumerate(items):
        a, b = int(words.first[i]), int(words.first[i + 1])
        m = min(window, b - a)
        if not m:
            continue
        spelled = [words.buf[words.start[k]:words.end[k]].tobytes() for k in range(a, b)]
        tests = by_length.setdefault(m, {})
        for k in range(b - a - m + 1):
            tests.setdefault(b" ".join(spelled[k:k + m]), (a + k, set()))[1].add(item)
    return [Patterns(m, np.stack([h[a:a + m] for a, _ in tests.values()]), list(tests), [sorted(x for x in o if x is not None) for _, o in tests.values()])
            for m, tests in by_length.items()]


def scan(blocks):
    def run(batches):
        release()
        for batch in slices(batches):
            words = Words(batch.column("text"), NOT_ALNUM, lower=True)
            h = words.hashes()
            change = np.zeros(len(h) + 1, np.int64)
            text_of, seen = words.text_of_word(), {}
            if "spans" in batch.schema.names:  # of the passes before
                earlier = batch.column("spans")
                owner = np.repeat(np.arange(words.texts), np.diff(earlier.offsets.to_numpy()))
                for name, step in (("from", 1), ("to", -1)):
                    np.add.at(change, words.first[owner] + earlier.flatten().field(name).to_numpy(), step)
                seen = {i: set(found) for i, found in enumerate(batch.column("items").to_pylist()) if found}
            for block in blocks:
                for patterns in map(Patterns.of, block.value):
                    for at, p in patterns.search(words, h):
                        change[at] += 1
                        change[at + patterns.m] -= 1
                        seen.setdefault(int(text_of[at]), set()).update(patterns.owners[p])
            hit = np.cumsum(change[:-1]) > 0
            edge = np.ones(len(hit), bool)
            edge[1:] = (hit[1:] != hit[:-1]) | (text_of[1:] != text_of[:-1])
            at = np.flatnonzero(edge)
            to = np.append(at[1:], len(hit))
            at, to = at[hit[at]], to[hit[at]]
            owner = text_of[at]
            spans = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words.texts))]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(at - words.first[owner], pa.int64()), pa.array(to - words.first[owner], pa.int64())], ["from", "to"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(words.counts, pa.int64()), pa.array(np.bincount(text_of[hit], minlength=words.texts), pa.int64()),
                 spans, pa.array([sorted(seen.get(i, ())) for i in range(words.texts)], pa.list_(pa.string()))],
                names=["row", "text", "n_words", "n_hit", "spans", "items"])
    return run


def load(benchmark, id="item_id", text="text", window=10, block_mb=8, pass_mb=16):
    """Yields, for each pass, the broadcast search tables of its items, in blocks of about block_mb MB of text.

    The driver builds one block at a time. Where one block does not do, items are written once, sorted by block, and each
    block reads its own part.
    """
    common.ship("unitgrid.llm.common", __name__)
    spark = benchmark.sparkSession
    items = benchmark.select(common.quoted(id).cast("string").alias("id"), common.quoted(text).alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / (block_mb * 1_000_000)))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    if n > 1:
        dealt = materialize(dealt.repartitionByRange("block").sortWithinPartitions("block"), "items")
    together = max(1, int(pass_mb // block_mb))
    for at in range(0, n, together):
        yield [spark.sparkContext.broadcast([vars(p) for p in build([(r.id, r.text) for r in dealt.filter(F.col("block") == i).select("id", "text").collect()], window)])
               for i in range(at, min(n, at + together))]


def find(docs, benchmark, text="text", item_id="item_id", item_text="text", window=10, block_mb=8, pass_mb=16):
    """Mark words inside windows of benchmark items.

    Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII bytes. A window is `window` consecutive words of an item,
    or all words of an item that has fewer. Returns all columns of `docs` and: n_words, n_hit (words inside any
    occurrence of a window), spans (hit words as [from, to) word ranges), items (ids, as strings, of items with an
    occurring window, sorted). A column of `docs` with one of these names is replaced. Null texts have no words; an
    item without words has no window; an item with a null id marks words and is not listed; equal ids are one item;
    empty tables give no rows or no hits.
    """
    made = ("n_words", "n_hit", "spans", "items")
    rest = common.rest_struct(docs, text, *made)
    state = docs.select(rest.alias("row"), common.quoted(text).alias("text"))
    schema = (f"row {state.schema['row'].dataType.simpleString()}, text string, n_words long, n_hit long, "
              "spans array<struct<from:long,to:long>>, items array<string>")
    before = None
    for blocks in load(benchmark, item_id, item_text, window, block_mb, pass_mb):
        if before is not None:  # the tables of the last pass are given up once its result is written
            written = materialize(state, "searched")
            for block in before:
                block.destroy()
            state = written.select("row", "text", "spans", "items")
        state, before = state.mapInArrow(scan(blocks), schema), blocks
    return state.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in common.others(docs, *made)], *made)
