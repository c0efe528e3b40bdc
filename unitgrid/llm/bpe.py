"""BPE encoding and decoding with the vocabulary file of a word-end tokenizer.

Method: pair occurrence index. The distinct words of a partition lie in one symbol array with links to the neighbour
on either side. Every pair that the vocabulary can merge has a list of all its positions; ranks that have positions
are applied in ascending order, each to all its positions at once, and the two new pairs at each merged place are
added to their lists. A merge only makes pairs of higher ranks (a token is made before it is part of another), so
one pass over the ranks gives every word the merges that it gets alone.

The vocabulary (a file of fixed size, measured before use) is read by the driver and broadcast. Texts are encoded
where they lie, without a shuffle; a task holds one portion of its partition, of bounded size, at a time.
"""

import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import release, slices

WORD_END = "</w>"
DEAD, EDGE = -2, -1
# Fixed value: how the vocabulary's file cuts normalized text into words; for ASCII the same in `re`.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_letters():
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def load(path, limit_mb=64):
    """Plain tables of a tokenizer file: token bytes by id, byte symbols, merges, special tokens."""
    if os.path.getsize(path) > limit_mb * 1_000_000:
        raise ValueError(f"{path} is larger than a vocabulary should be")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in [*vocab.items(), *special.items()]:
        tokens[i] = token.encode()
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
    made = np.array([vocab[a + b] for a, b in merges], np.int32)
    return {"tokens": tokens, "special": special, "left": left, "right": right, "made": made,
            "inner": np.array([vocab[letters[b]] for b in range(256)], np.int32),
            "final": np.array([vocab[letters[b] + WORD_END] for b in range(256)], np.int32)}


class Merger:
    """Applies the merges to many words at once."""

    def __init__(self, tables):
        self.width = len(tables["tokens"])
        code = tables["left"] * self.width + tables["right"]
        order = np.argsort(code)
        self.code, self.rank = code[order], order
        self.left, self.right, self.made = tables["left"], tables["right"], tables["made"]
        self.inner, self.final = tables["inner"], tables["final"]

    def ranks(self, a, b):
        """Rank of each pair, -1 where no merge exists."""
        code = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((self.code[at] == code) & (a >= 0) & (b >= 0), self.rank[at], -1)

    def encode(self, words):
        """(ids of all words in a row, first id of each word, with the end) for non-empty byte strings."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if not len(lengths):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        body = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum(lengths)
        symbol = self.inner[body]
        symbol[end - 1] = self.final[body[end - 1]]
        # one more place at either end, so that every symbol has neighbours; words are apart by their edges
        n = len(symbol)
        symbol = np.concatenate([[EDGE], symbol, [EDGE]]).astype(np.int32)
        after = np.arange(1, n + 3, dtype=np.int64)
        before = np.arange(-1, n + 1, dtype=np.int64)
        after[end] = n + 1  # the last symbol of a word has no neighbour on the right
        before[end[:-1] + 1] = 0
        lists, heap = {}, []

        def add(position):
            rank = self.ranks(symbol[position], symbol[after[position]])
            ok = rank >= 0
            rank, position = rank[ok], position[ok]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, position = rank[order], position[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.append(0, cut)].tolist(), np.split(position, cut)):
                if r in lists:
                    lists[r].append(part)
                else:
                    lists[r] = [part]
                    heapq.heappush(heap, r)

        add(np.arange(1, n + 1))
        while heap:
            r = heapq.heappop(heap)
            parts = lists.pop(r)
            a, b = self.left[r], self.right[r]
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:  # in a run of one symbol every other pair, from the left
                start = np.append(True, at[1:] != after[at[:-1]])
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            follower = after[gone]
            symbol[at], symbol[gone] = self.made[r], DEAD
            after[at] = follower
            inside = follower <= n
            before[follower[inside]] = at[inside]
            earlier = before[at]
            add(np.concatenate([earlier[earlier > 0], at[inside]]))
        alive = symbol[1:-1] >= 0
        kept = np.concatenate([[0], np.cumsum(alive)])
        return symbol[1:-1][alive], np.concatenate([[0], kept[end]])


class Numbers(dict):
    """Numbers its keys in the order in which they come."""

    def __missing__(self, key):
        self[key] = value = len(self)
        return value


def unicode_words():
    """Normalized words of a text by the library's Unicode tables, which are not those of Python or of `regex`."""
    from tokenizers import Regex, normalizers, pre_tokenizers
    normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
    split = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True).pre_tokenize_str
    return lambda text: [w.encode() for w, _ in split(normal(text))]


def pieces(chunk, special, splitter, in_words):
    """A chunk without ASCII white space as words (bytes) and special ids (int)."""
    if chunk.isascii() and b"<" not in chunk:
        return [p.encode() for p in ASCII_WORDS.findall(chunk.lower().decode())]
    out = []
    for part in splitter.split(chunk.decode()) if splitter else [chunk.decode()]:
        if part in special:
            out.append(special[part])
        elif part:
            out += in_words(part)
    return out


def gather(values, first, which):
    """Concatenation of the slices values[first[w]:first[w + 1]] for w in which, and the slices' lengths."""
    lengths = np.diff(first)[which]
    ends = np.cumsum(lengths)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[which] - (ends - lengths), lengths)
    return values[place], lengths


def encode_texts(merger, special, splitter, texts):
    """Packed ids of each text (bytes). Words and merges are found once for each distinct chunk and word."""
    chunks, words = Numbers(), Numbers()
    number, in_words = chunks.__getitem__, unicode_words()
    codes = [np.fromiter(map(number, t.split()), np.int32) for t in texts]
    texts.clear()
    del number
    flat, counts = [], []
    for chunk in chunks:
        got = pieces(chunk, special, splitter, in_words)
        counts.append(len(got))
        flat += [words[p] if isinstance(p, bytes) else -1 - p for p in got]
    flat, counts = np.array(flat, np.int64), np.array(counts, np.int64)
    n_words, in_order = len(words), list(words)
    del chunks, words
    ids, first = merger.encode(in_order)
    del in_order
    # special ids stand as one-id words behind the others
    extra = np.unique(flat[flat < 0])
    ids = np.concatenate([ids, (-1 - extra).astype(np.int32)])
    first = np.concatenate([first, first[-1] + 1 + np.arange(len(extra))])
    flat = np.where(flat < 0, n_words + np.searchsorted(extra, flat), flat)
    chunk_ids, lengths = gather(ids, first, flat)
    word_ends = np.concatenate([[0], np.cumsum(lengths)])
    chunk_first = word_ends[np.concatenate([[0], np.cumsum(counts)])]
    for c in codes:
        yield gather(chunk_ids, chunk_first, c)[0].astype("<u4").tobytes()


def encoder(tables, portion):
    def flush(merger, special, splitter, held):
        out = encode_texts(merger, special, splitter, [t for batch in held for t in batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()])
        for batch in held:
            for part in slices([batch], 2_000_000):
                packed = [next(out) for _ in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("text"), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
                    names=["row", "text", "n_tokens", "ids"])

    def run(batches):
        release()
        t = tables.value
        merger, special = Merger(t), t["special"]
        splitter = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        held, size = [], 0
        for batch in slices(batches):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= portion:
                yield from flush(merger, special, splitter, held)
                held, size = [], 0
                release()
        yield from flush(merger, special, splitter, held)
    return run


def decoder(tables):
    def run(batches):
        release()
        tokens = tables.value["tokens"]
        for batch in slices(batches, 1_000_000, "ids"):
            texts = []
            for packed in batch.column("ids").to_pylist():
                texts.append(b" ".join(map(tokens.__getitem__, np.frombuffer(packed or b"", "<u4").tolist())))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string())], names=["row", "decoded"])
    return run


def vocabulary(spark, path):
    common.ship("unitgrid.llm.common", __name__)
    return spark.sparkContext.broadcast(load(path))


def encode(docs, tables, text="text", portion_mb=5):
    """All columns of `docs` and: n_tokens (long), ids (binary, little-endian unsigned 32-bit numbers).

    `tables` comes from `vocabulary`. White space is dropped, text is normalized (NFC) and lowered, special tokens
    spelled out in a text become their ids. A null or empty text has no tokens. A column of `docs` with one of the
    new names is replaced. Repeated rows give repeated results, an empty table an empty one. A task works on about
    `portion_mb` MB of text at a time, or one text if that is longer.
    """
    made = ("n_tokens", "ids")
    packed = docs.select(common.rest_struct(docs, text, *made).alias("row"), common.quoted(text).alias("text"))
    done = packed.mapInArrow(encoder(tables, portion_mb * 1_000_000), f"row {packed.schema['row'].dataType.simpleString()}, text string, n_tokens long, ids binary")
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in common.others(docs, *made)], *made)


def decode(encoded, tables, ids="ids"):
    """All columns of `encoded` and: decoded, its tokens as the vocabulary spells them, joined by spaces; null ids give "".

    A column `decoded` of the input is replaced.
    """
    packed = encoded.select(common.rest_struct(encoded, "decoded").alias("row"), common.quoted(ids).alias("ids"))
    done = packed.mapInArrow(decoder(tables), f"row {packed.schema['row'].dataType.simpleString()}, decoded string")
    return done.select(*[F.col("row").getField(c).alias(c) for c in common.others(encoded, "decoded")], "decoded")
