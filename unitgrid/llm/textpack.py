"""Words of many texts at once: numpy arrays over the UTF-8 bytes of one Arrow column.

Task helpers; they run inside `applyInArrow` and `mapInArrow` on bounded batches. Hashes are fixed functions
of the bytes, so every executor, and a task that runs again, computes the same ones.
"""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Separators of letters-and-digits words: ASCII other than 0-9, A-Z (lowered before) and a-z.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = False
NOT_ALNUM[97:123] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
BASE = 0xD6E8FEB86659FD93


def release():
    """Give memory that earlier batches freed back to the system; a Python worker outlives its tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mixed(x, seed=0):
    """Finalizer of splitmix64: a bijection that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
        return x ^ (x >> np.uint64(31))


BYTE_HASH = mixed(np.arange(256, dtype=np.uint64), 7)


def powers(base, n):
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = base
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


def bytes_of(column):
    """(bytes, offsets) of a string column; null counts as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


class Words:
    """Word boundaries of a batch of texts.

    `buf` the bytes (lower-cased if asked), `start`/`end` byte offsets of each word, `first[d]` the index of the
    first word of text d (`first[-1]` the number of words).
    """

    def __init__(self, column, separators=SPACE, lower=False):
        buf, offsets = bytes_of(column)
        self.buf = LOWER[buf] if lower else buf
        inside = ~separators[self.buf]
        self.inside = inside
        edge = np.empty(len(buf) + 1, bool)
        edge[0] = edge[-1] = False
        edge[1:-1] = inside[:-1]
        edge[offsets] = False  # a word never reaches over the start of a text
        self.start = np.flatnonzero(inside & ~edge[:-1])
        after = np.empty(len(buf) + 1, bool)
        after[-1] = False
        after[:-1] = inside
        after[offsets] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.offsets = offsets
        self.first = np.searchsorted(self.start, offsets)
        self.lengths = self.end - self.start
        self.texts = len(offsets) - 1

    @property
    def counts(self):
        return np.diff(self.first)

    def text_of_word(self):
        return np.repeat(np.arange(self.texts), self.counts)

    def hashes(self):
        """64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        out, power = np.empty(len(self.start), np.uint64), powers(BASE, int(self.lengths.max()))
        for i, j, body, first in self._portions():
            place = np.arange(len(body)) - np.repeat(first, self.lengths[i:j])
            with np.errstate(over="ignore"):
                total = np.add.reduceat(BYTE_HASH[body] * power[place], first)
                out[i:j] = mixed(total + self.lengths[i:j].astype(np.uint64) * STEP)
        return out

    def _portions(self, size=1_000_000):
        """Runs of words of about `size` bytes (one word at least): (from, to, their bytes, where each starts in these)."""
        ends = np.cumsum(self.lengths)
        body, i = self.buf[self.inside], 0
        while i < len(ends):
            done = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + size, "right")))
            yield i, j, body[done:int(ends[j - 1])], ends[i:j] - self.lengths[i:j] - done
            i = j

    def has_window(self, k):
        """For each word: does a window of k words of the same text start there?"""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start)) >= k

    def joined(self, keep=None):
        """Kept words of each text joined by one space, as an Arrow string array."""
        keep = np.ones(len(self.start), bool) if keep is None else keep
        text = self.text_of_word()[keep]
        words = np.bincount(text, minlength=self.texts)
        sizes = np.bincount(text, weights=self.lengths[keep], minlength=self.texts).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes + np.maximum(words - 1, 0))])
        # where a kept word starts: the bytes of kept words before it, and one space for each before it in its text
        start = np.zeros(len(keep), np.int64)
        start[keep] = np.cumsum(self.lengths[keep]) - self.lengths[keep] + np.arange(len(text)) - np.cumsum(words > 0)[text] + 1
        out = np.full(int(offsets[-1]), 32, np.uint8)
        for i, j, body, first in self._portions():
            stays = np.repeat(keep[i:j], self.lengths[i:j])
            place = np.arange(len(body)) + np.repeat(start[i:j] - first, self.lengths[i:j])
            out[place[stays]] = body[stays]
        return strings(out, offsets)


def strings(data, offsets):
    """Arrow string array from bytes and offsets."""
    if offsets[-1] < 2**31:
        return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def window_hashes(h, k, base=0xA0761D6478BD642F, seed=1):
    """Hash of every k consecutive words (len(h) - k + 1 of them), by doubling."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    total, done, piece, width = None, 0, h, 1
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                if total is None:
                    total = piece
                else:
                    tail = piece[done:]
                    total = total[:len(tail)] + np.uint64(pow(base, done, 2**64)) * tail[:len(total)]
                done += width
            if width * 2 > k:
                break
            piece = piece[:len(piece) - width] + np.uint64(pow(base, width, 2**64)) * piece[width:]
            width *= 2
    return mixed(total[:len(h) - k + 1], seed)


def member(values, sorted_set):
    """values in sorted_set? A small bit table refuses most values before the binary search."""
    if not len(sorted_set) or not len(values):
        return np.zeros(len(values), bool)
    table = np.zeros(1 << 20, bool)
    mask = np.uint64((1 << 20) - 1)
    table[(sorted_set & mask).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(values & mask).astype(np.int64)])
    found = np.minimum(np.searchsorted(sorted_set, values[maybe]), len(sorted_set) - 1)
    out = np.zeros(len(values), bool)
    out[maybe[sorted_set[found] == values[maybe]]] = True
    return out


def slices(batches, limit=4_000_000, column="text"):
    """Cut Arrow batches into pieces of at most about `limit` bytes of text (one text at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
