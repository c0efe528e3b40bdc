"""URL filter: rules for hosts and paths first, then a weighted vocabulary searched with an Aho-Corasick automaton.

Strict terms alone reject an address, soft ones only if several distinct ones occur. A term counts where no further
letter touches it. All addresses of an Arrow batch go through the automaton together: their bytes are cut into lanes that
overlap by the longest term, and one step moves every lane on by one byte.
"""

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.llm.textpack import bytes_of, slices

STRICT, SOFT = 2, 1

#: Terms and weights chosen for this library; any other vocabulary can be given.
VOCABULARY = {
    **dict.fromkeys(["adult", "camgirl", "camgirls", "casino", "casinos", "content-farm", "escort", "escorts", "hentai", "link-farm", "malware",
                     "phishing", "porn", "porno", "pornhub", "sexcam", "spam-farm", "viagra", "warez", "xxx"], STRICT),
    **dict.fromkeys(["ads", "adserver", "banner", "bet", "bets", "betting", "bonus", "cams", "cheap", "click", "crack", "dating", "deal", "deals",
                     "discount", "download", "farm", "free", "gambling", "hot", "jackpot", "keygen", "loan", "loans", "lottery", "nude", "pharmacy",
                     "pill", "pills", "poker", "popup", "prize", "replica", "serial", "sex", "slots", "spam", "spin", "torrent", "track", "tracker",
                     "tracking", "webcam", "win", "winner"], SOFT),
}

LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True  # bytes of letters outside ASCII


class Automaton:
    """Transitions of all states for all bytes, and the terms that end in each state."""

    def __init__(self, terms):
        self.terms = sorted({t.encode() for t in terms if t})
        table, ends, fail = [np.zeros(256, np.int32)], [[]], [0]
        for n, term in enumerate(self.terms):
            state = 0
            for byte in term:
                if not table[state][byte]:
                    table.append(np.zeros(256, np.int32))
                    ends.append([])
                    fail.append(0)
                    table[state][byte] = len(table) - 1
                state = int(table[state][byte])
            ends[state].append(n)
        queue = deque(int(s) for s in np.unique(table[0]) if s)
        while queue:
            state = queue.popleft()
            back = table[fail[state]]
            ends[state] = ends[state] + ends[fail[state]]
            for byte in np.flatnonzero(table[state]).tolist():
                fail[int(table[state][byte])] = int(back[byte])
                queue.append(int(table[state][byte]))
            table[state] = np.where(table[state] > 0, table[state], back)
        self.next = np.array(table)
        self.count = np.array([len(e) for e in ends])
        self.first = np.cumsum(self.count) - self.count
        self.ending = np.array([n for e in ends for n in e], np.int64)
        self.length = np.array([len(t) for t in self.terms], np.int64)
        self.longest = max([len(t) for t in self.terms], default=0)

    def hits(self, body, lane=512):
        """(position of the last byte, term) of every occurrence in `body`."""
        if not len(body) or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes, lead = -(-len(body) // lane), self.longest - 1
        padded = np.concatenate([np.zeros(lead, np.uint8), body, np.zeros(lanes * lane - len(body), np.uint8)])
        state, where, what = np.zeros(lanes, np.int32), [], []
        begin = np.arange(lanes) * lane
        for step in range(lead + lane):  # the first `lead` bytes only bring each lane into its state
            state = self.next[state, padded[begin + step]]
            if step >= lead:
                at = np.flatnonzero(self.count[state])
                if len(at):
                    where.append(begin[at] + step - lead)
                    what.append(state[at])
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where, what = np.concatenate(where), np.concatenate(what)
        n = self.count[what]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(where, n), self.ending[np.repeat(self.first[what], n) + nth]

    def whole(self, body, offsets):
        """(text, term) of the distinct terms of each text that no letter touches. Texts are separated by one zero byte."""
        end, term = self.hits(body)
        start = end - self.length[term] + 1
        letter = np.concatenate([[False], LETTER[body], [False]])
        free = ~letter[start] & ~letter[end + 2]
        text = np.searchsorted(offsets, start[free], "right") - 1
        pairs = np.unique(text * max(1, len(self.terms)) + term[free])
        return pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms))


def rule_table(rules):
    """{host: [(path, name, verdict)], longest path first} of rules (host, path, verdict)."""
    table = {}
    for host, path, verdict in rules:
        table.setdefault(host, []).append((path, host + path, verdict))
    return {h: sorted(r, key=lambda x: (-len(x[0]), x[1:])) for h, r in table.items()}


def fitting(table, host, path):
    """(name, verdict) of the longest rule that fits the host, or one of its parents, and the start of the path."""
    best, parent = None, host
    while parent:
        for start, name, verdict in table.get(parent, ()):
            if path.startswith(start):
                if best is None or len(name) > len(best[0]):
                    best = name, verdict
                break
        parent = parent.partition(".")[2]
    return best or (None, None)


def _judge(vocabulary, table, reject_at):
    def run(batches):
        search = Automaton(vocabulary)
        weight = np.array([vocabulary[t.decode()] for t in search.terms], np.int64)
        for batch in slices(batches, column="searched"):
            body, offsets = bytes_of(batch.column("searched"))
            texts, terms = search.whole(body, offsets)
            score = np.bincount(texts, weights=weight[terms], minlength=batch.num_rows).astype(np.int64)
            found, names = [[] for _ in range(batch.num_rows)], [t.decode() for t in search.terms]
            for text, term in zip(texts.tolist(), terms.tolist()):
                found[text].append(names[term])
            ruled = [fitting(table, h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            verdict = [v or ("block" if s >= reject_at else "allow") for (_, v), s in zip(ruled, score.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("host"), batch.column("path"), pa.array([r for r, _ in ruled], pa.string()),
                 pa.array(verdict, pa.string()), pa.array(score, pa.int64()), pa.array(found, pa.list_(pa.string()))],
                names=["row", "host", "path", "rule", "verdict", "score", "terms"])
    return run


def host_of(url):
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; empty for a null or without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """From the end of the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(rows, url="url", rules=(), vocabulary=None, reject_at=STRICT):
    """Allow or block every address.

    `rules`: (host, path, verdict); a rule fits its host and all subdomains if the path starts with the rule's, and the
    longest name (host + path) wins, of equally long ones the one with the longest host; one rule with both verdicts allows. Where none fits, the distinct
    terms of `vocabulary` ({term: weight}, lower case) in host and path (A-Z lowered) are weighed; `reject_at` or more
    blocks, so one strict term or two soft ones do. Rules and vocabulary go to every task whole; they are lists that people
    write, and together over 64 MB of text are refused.

    Returns all columns of `rows` and: host, path, rule (name or null), verdict (allow or block), score (sum of weights),
    terms (sorted). A column of `rows` with one of these names is replaced. A null or empty address, or one without `://`,
    has an empty host and path, fits no rule and is allowed. Repeated rows stay; an empty table gives an empty one.
    """
    vocabulary = dict(VOCABULARY if vocabulary is None else vocabulary)
    rules = list(rules)
    if sum(len(t.encode()) for t in vocabulary) + sum(len((h + p).encode()) for h, p, _ in rules) > 64_000_000:
        raise ValueError("rules and vocabulary are larger than 64 MB")
    common.ship("unitgrid.llm.common", __name__)
    made = ("host", "path", "rule", "verdict", "score", "terms")
    q = common.quoted
    packed = rows.select(common.rest_struct(rows, *made).alias("row"), host_of(q(url)).alias("host"), path_of(q(url)).alias("path"))
    lowered = F.translate("path", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    packed = packed.withColumn("searched", F.concat("host", lowered, F.lit("\0")))
    done = packed.mapInArrow(_judge(vocabulary, rule_table(rules), reject_at), f"row {packed.schema['row'].dataType.simpleString()}, host string, path string, "
                             "rule string, verdict string, score long, terms array<string>")
    return done.select(*[F.col("row").getField(c).alias(c) for c in common.others(rows, *made)], *made)
