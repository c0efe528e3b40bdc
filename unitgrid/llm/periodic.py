"""Periodic runs of words: stretches that repeat one period at least three times.

Method: online dyadic square catching. Words are appended one after the other; whenever a block of 1, 2, 4, 8 ... words is
complete, a catcher stands over it and waits for the block to come again. A square of period p holds, in its first half,
a complete block of m words for the m with 2m - 1 <= p < 4m - 1, so the catcher of a block at s only has to watch the words
appended at s + 2m - 1 .. s + 4m - 2: at any time two catchers of a level are awake. An appended word makes one more suffix
of m words, which is compared with the blocks of both. A block that comes again at distance p is part of a square; blocks
one after the other that come again at one distance belong to squares that merge into one run, whose ends lie less than a
block beyond and are found word by word.

All texts of a portion are appended together, and one numpy step advances the comparisons of a level for all words of a
stretch of them. Suffixes of m words are compared on 64 bits.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import STEP, Words, mixed, slices

APPENDED = 1 << 19  # words whose comparisons are made in one step


def _need(p, least, times):
    """Words that have to repeat at distance p for a run that counts."""
    return max(least - p, (times - 1) * p)


def _blocks_needed(m, least, times):
    """Complete blocks of m words, one after the other, that every counting run of this level repeats."""
    periods = range(2 * m - 1, 4 * m - 1 if m < least else 2 * m)  # the shortest needs fewest once `least` plays no part
    return max(1, min((_need(p, least, times) - (m - 1)) // m for p in periods))


def _caught(suffix, rel, count, level, behind):
    """Which suffixes (by first word) repeat the block whose catcher is `behind` blocks back, and where that block starts.

    rel: place of the word in its text; count: words of its text.
    """
    m = 1 << level
    hit = np.zeros(len(suffix), bool)
    for lo in range(0, len(suffix), APPENDED):
        part = slice(lo, lo + APPENDED)
        place = rel[part]
        block = ((place + 1) >> level) - behind
        at = np.flatnonzero((block >= 0) & (place + m <= count[part]))
        start = lo + at - place[at] + (block[at] << level)
        hit[lo + at] = suffix[lo + at] == suffix[start]
    return hit


def _chains(hit, m, least):
    """First suffix and number of hits of each chain p, p + m, p + 2m ... of at least `least` hits."""
    long, have = hit.copy(), 1
    while have < least:
        step = min(have, least - have)
        shifted = np.zeros(len(long), bool)
        if step * m < len(long):
            shifted[:-step * m] = long[step * m:]
        long &= shifted
        have += step
    first = np.flatnonzero(long)
    before = first - m
    first = first[(before < 0) | ~hit[np.maximum(before, 0)]]
    for p in first.tolist():
        more, n = m, 0
        while True:  # look at the chain in growing pieces
            piece = hit[p + n * m:p + (n + more) * m:m]
            stop = np.flatnonzero(~piece[:more])
            if len(stop) or len(piece) < more:
                yield p, n + (int(stop[0]) if len(stop) else len(piece))
                break
            n, more = n + more, more * 2


def _agree(a, b):
    """How many words agree from the start."""
    differs = np.flatnonzero(a != b)
    return int(differs[0]) if len(differs) else len(a)


class Catchers:
    """Runs of the texts appended so far. `runs`: (first word, words, period) by word number over all texts."""

    def __init__(self, least, times):
        self.least, self.times, self.runs = least, times, []

    def append(self, h, first):
        """Append the words of texts: hashes `h` and the number of the first word of each text (and of the end)."""
        counts = np.diff(first)
        owner_first, owner_count = np.repeat(first[:-1], counts), np.repeat(counts, counts)
        cover = np.full(len(h), -1, np.int32)  # for each word the run of the least period over it
        known = {}
        at, suffix, level = np.arange(len(h)), h.copy(), 0
        rel, count = at - owner_first, owner_count
        while len(at):
            m = 1 << level
            least = _blocks_needed(m, self.least, self.times)
            for behind in (2, 3):
                hit = _caught(suffix, rel, count, level, behind)
                for p, n in _chains(hit, m, least):
                    period = int(rel[p] - ((((rel[p] + 1) >> level) - behind) << level))
                    self._merge(h, first, cover, known, int(at[p]), n * m, period)
            # one level up: pairs of suffixes, of the texts that are long enough
            level += 1
            stays = count >= max(self.least, self.times * ((2 << level) - 1))
            longer = np.zeros(len(suffix), np.uint64)
            with np.errstate(over="ignore"):
                longer[:-m] = mixed(suffix[:-m] * STEP + suffix[m:], level)
            if stays.all():
                suffix = longer
            else:
                at, suffix, rel, count = at[stays], longer[stays], rel[stays], count[stays]
        return self

    def _merge(self, h, first, cover, known, again, length, period):
        """A chain of squares: `length` words from `again` repeat those `period` words before. Find the run's ends."""
        run = int(cover[again])
        if run >= 0:
            start, size, least = self.runs[run]
            if period % least == 0 and start <= again - period and again + length <= start + size:
                return  # squares of a multiple of that run's period
        text = int(np.searchsorted(first, again, "right")) - 1
        lo, hi = int(first[text]), int(first[text + 1])
        # less than a block, so less than `length`, is left on either side
        left = _agree(h[max(lo, again - period - length):again - period][::-1], h[max(lo + period, again - length):again][::-1])
        behind, end = again + length, min(hi, again + 2 * length)
        right = _agree(h[behind - period:end - period], h[behind:end])
        start, size = again - period - left, left + length + right + period
        if size < max(self.least, self.times * period) or any(period % q == 0 for q in known.get((start, size), ())):
            return
        known.setdefault((start, size), []).append(period)
        free = cover[start:start + size]
        free[free < 0] = len(self.runs)
        self.runs.append((start, size, period))


def _find(least, times):
    def run(batches):
        for batch in slices(batches):
            words = Words(batch.column("text"))
            runs = Catchers(least, times).append(words.hashes(), words.first).runs
            start, size, period = (np.array(c, np.int64) for c in (zip(*runs) if runs else ((), (), ())))
            order = np.lexsort((period, start))
            start, size, period = start[order], size[order], period[order]
            text = np.searchsorted(words.first, start, "right") - 1
            change = np.zeros(len(words.start) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + size, -1)
            kept = np.cumsum(change[:-1]) == 0
            dropped = np.bincount(words.text_of_word()[~kept], minlength=words.texts)
            found = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(text, minlength=words.texts))]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(start - words.first[text], pa.int64()), pa.array(size, pa.int64()), pa.array(period, pa.int64())],
                                           ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(words.counts, pa.int64()), found, pa.array(dropped, pa.int64()), words.joined(kept)],
                                             names=["row", "n_words", "runs", "n_dropped", "collapsed"])
    return run


def collapse(docs, text="text", least=24, times=3):
    """Find periodic runs and cut each down to one period.

    A run is a stretch of words with smallest period p (words p apart are identical), of at least max(least, times * p)
    words, which no neighbouring word extends. Words are runs of bytes other than ASCII white space, unchanged. A word
    goes if any run holds it after that run's first p words.

    Returns the other columns of `docs` and: n_words, runs (start, length and period in words, by start and period),
    n_dropped, collapsed (words that stay, joined by one space). A column of `docs` with one of these names is
    replaced. A null or empty text has no words, no runs and an empty `collapsed`. Repeated rows are rows each; an empty
    table gives an empty one. A text is worked on whole, in memory in proportion to its words (about 60 bytes a word).
    """
    if times < 2:
        raise ValueError("a run repeats its period at least twice")
    common.ship("unitgrid.llm.common", __name__)
    made = ("n_words", "runs", "n_dropped", "collapsed")
    packed = docs.select(common.rest_struct(docs, text, *made).alias("row"), common.quoted(text).alias("text"))
    done = packed.mapInArrow(_find(least, times), f"row {packed.schema['row'].dataType.simpleString()}, n_words long, "
                             "runs array<struct<start:long,length:long,period:long>>, n_dropped long, collapsed string")
    return done.select(*[F.col("row").getField(c).alias(c) for c in common.others(docs, text, *made)], *made)
