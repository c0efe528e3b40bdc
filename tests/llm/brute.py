"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode())


def alnum(text):
    return ALNUM.findall((text or "").encode().lower())


def shingles(text, k=5):
    w = WORD.findall((text or "").encode().lower())
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(docs, percent=80):
    """[(n_shingles, component_id)] of (doc_id, text) rows."""
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return [(len(s), least.get(top(i))) for i, s in enumerate(sets)]


def removed(texts, window=35):
    """Flags of the words that go, per text."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append(gone)
    return all_words, out


def contaminated(texts, items, window=10):
    """(words, hit words, item ids) per text."""
    windows = {}
    for item, text in items:
        w = alnum(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(None if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = alnum(text), None, set()
        hit = [False] * len(w)
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                ids = windows.get(tuple(w[i:i + m]))
                if ids:
                    hit[i:i + m] = [True] * m
                    found |= ids
        out.append((len(w), sum(hit), sorted(x for x in found if x is not None)))
    return out


def url(address, rules, vocabulary, reject_at=2):
    """(host, path, rule, verdict, score, terms) of an address."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", address or "")
    low = lambda s: re.sub("[A-Z]", lambda x: x[0].lower(), s)
    host, path = (low(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, None)
    terms = sorted(t for t in vocabulary if re.search(rf"(?<![a-z\u0080-\U0010FFFF]){re.escape(t)}(?![a-z\u0080-\U0010FFFF])", host + low(path)))
    score = sum(vocabulary[t] for t in terms)
    return host, path, rule, verdict or ("block" if score >= reject_at else "allow"), score, terms


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes):
    """Root of the nodes, and for each node its siblings per level as (left, right)."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = p - p % 3
            sides[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1:run + 3])))
        nodes = [_h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [p // 3 for p in at]
    return nodes[0], sides


def manifest(rows):
    """Rows of op12 for (doc_id, source, lang, n_chars, text) rows."""
    leaf = lambda *v: _h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in v])
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
        low[s] = _tree([x[2] for x in groups[s]])
    root, high = _tree([low[s][0] for s in order])
    out = []
    for s, above in zip(order, high):
        for (_, _, node, r), own in zip(groups[s], low[s][1]):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf(*r[:4], text)
            for left, right in own + above:
                folded = _h(left, folded, right)
            out.append((r[0], node, low[s][0], root, _h(*[x + y for x, y in own + above]), folded, folded == root))
    return out


def runs(words, least, times):
    """(start, length, period) of all periodic runs, by start and period."""
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, times * p):
                found.setdefault((i, j - i + p), []).append(p)
            i = j + 1
    return sorted((a, n, p) for (a, n), periods in found.items() for p in periods if not any(p % q == 0 for q in periods if q < p))
