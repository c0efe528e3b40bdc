"""Which keys occur elsewhere? Batches send their distinct keys to buckets; buckets answer each batch.

A batch sends a key once, however often it holds it, together with two marks: seen more than once here, and
wanted here. So a key that a third of all texts contain costs one entry per batch. Keys travel as packed
binary, one row per (batch, bucket), and the answers are packed bits in the order in which keys were sent.
"""

import numpy as np
import pyarrow as pa

from unitgrid.llm.textpack import release

SENT = "bucket int, batch int, body binary, n long"
ANSWER = "batch int, kind int, bucket int, body binary"


class Keys:
    """Distinct (bucket, key) of a batch in a fixed order, with their marks."""

    def __init__(self, bucket, key, marked=None):
        order = np.argsort(key)
        key, bucket = key[order], bucket[order]
        marked = np.zeros(len(key), bool) if marked is None else marked[order]
        order = np.argsort(bucket, kind="stable")
        bucket, key, marked = bucket[order], key[order], marked[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
        at = np.flatnonzero(new)
        self.bucket, self.key = bucket[at], key[at]
        self.many = np.diff(np.append(at, len(key))) > 1
        self.marked = np.logical_or.reduceat(marked, at) if len(at) else marked[:0]

    def cuts(self):
        """(bucket, from, to) of each bucket that has keys."""
        if not len(self.bucket):
            return []
        at = np.flatnonzero(np.append(True, self.bucket[1:] != self.bucket[:-1]))
        return zip(self.bucket[at].tolist(), at.tolist(), np.append(at[1:], len(self.bucket)).tolist())

    def rows(self, batch):
        """Arrow table in the form SENT: keys, then the two marks as packed bits."""
        out = [(b, self.key[i:j].tobytes() + np.packbits(self.many[i:j]).tobytes() + np.packbits(self.marked[i:j]).tobytes(), j - i)
               for b, i, j in self.cuts()]
        return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([batch] * len(out), pa.int32()),
                         pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int64())],
                        names=["bucket", "batch", "body", "n"])

    def answered(self, answers):
        """Bits of all keys from the answers {bucket: packed bits}; a bucket without an answer said no to all."""
        bits = np.zeros(len(self.key), bool)
        for b, i, j in self.cuts():
            if b in answers:
                bits[i:j] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=j - i).view(bool)
        return bits


def judge(kind, dtype, need_mark):
    """Task function of a bucket: yes to keys seen at least twice in all (and, with need_mark, marked somewhere)."""
    def run(table):
        release()
        width = np.dtype(dtype).itemsize
        bodies, sizes = table.column("body"), table.column("n").to_numpy()
        parts = []
        for body, n in zip(bodies, sizes.tolist()):
            raw = body.as_buffer()
            bits = (n + 7) // 8
            parts.append((np.frombuffer(raw, dtype, n), np.unpackbits(np.frombuffer(raw, np.uint8, bits, n * width), count=n).view(bool),
                          np.unpackbits(np.frombuffer(raw, np.uint8, bits, n * width + bits), count=n).view(bool)))
        keys = np.concatenate([p[0] for p in parts])
        ordered = np.sort(keys)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        yes = np.unique(np.concatenate([twice, *(p[0][p[1]] for p in parts)]))
        if need_mark:
            yes = yes[_in(yes, np.unique(np.concatenate([p[0][p[2]] for p in parts])))]
        batches, bucket, out = table.column("batch").to_pylist(), table.column("bucket")[0].as_py(), []
        for batch, (part, _, marked) in zip(batches, parts):
            bits = _in(part, yes)
            if need_mark:
                bits &= marked
            if bits.any():
                out.append((batch, np.packbits(bits).tobytes()))
        return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([kind] * len(out), pa.int32()),
                         pa.array([bucket] * len(out), pa.int32()), pa.array([r[1] for r in out], pa.binary())],
                        names=["batch", "kind", "bucket", "body"])
    return run


def _in(values, ordered):
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def by_kind(table, kind):
    """Answers of one kind as {bucket: bits}."""
    return {b: body for k, b, body in zip(table.column("kind").to_pylist(), table.column("bucket").to_pylist(),
                                          table.column("body").to_pylist()) if k == kind}
