"""N-gram Jaccard join: documents whose sets of word shingles are similar, as connected components.

Method: token-group matrix. Similar sets are put into groups, a group stores the union of its members' tokens, a
query set's overlap with the union bounds its overlap with every member, and only groups that the bound lets
through are opened. Here the tokens are 5-word shingles (64-bit hashes) and every set is a query.

1. *Everything as one group.* A token counts only if another text has it too (`ballots`). A set of which less than
   the threshold is so shared is linked with nothing; most texts end here. Equal sets become one node.
2. *Groups.* Nodes meet in blocks of bounded size by their least token under two hash orders, a large group being
   dealt over several blocks, by another dealing each time. Inside a block all links are found exactly. Links make
   provisional components.
3. *Matrix.* Tokens that occur in one component only are of no use to further links, and nodes left with too few
   others are done. The rest, in groups of one least token and of bounded size, gives the matrix rows (token,
   group). A node probes it with its rarest tokens, as many as a linked set cannot all miss, for groups that hold
   greater components; in each group found, the bound is checked against the union, then members are compared.
   The new links, and so the components, are complete: every pair of nodes was in one component already, or
   excluded by a bound, or compared.

Work inside a large group of near copies is linear in it: blocks are of bounded size, and once the blocks are one
component, no token of theirs is shared with another.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unitgrid.llm import ballots, common
from unitgrid.llm.graph import components as connected
from unitgrid.llm.textpack import SPACE, Words, mixed, release, window_hashes
from unitgrid.session import discard, materialize

LOW32 = np.uint64(0xFFFFFFFF)
BLOCK = 256  # nodes of a block, on average


def _shingles(column, size):
    """Distinct shingles of each text: (text index, hash), ordered by both; a short text's words are one shingle."""
    words = Words(column, SPACE, lower=True)
    h, counts = words.hashes(), words.counts
    at = np.flatnonzero(words.has_window(size))
    text, value = [words.text_of_word()[at]], [window_hashes(h, size, seed=size)[at] if len(at) else np.zeros(0, np.uint64)]
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        if len(short):
            text.append(short)
            value.append(window_hashes(h, k, seed=k)[words.first[short]])
    text, value = np.concatenate(text), np.concatenate(value)
    order = np.argsort(value)
    order = order[np.argsort(text[order].astype(np.uint16 if words.texts < 65536 else np.int64), kind="stable")]
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return words.texts, text[new], value[new]


def _bucket(value, buckets):
    return ((value >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), (value & LOW32).astype(np.uint32)


def send_tokens(size, buckets):
    def run(table):
        release()
        _, _, value = _shingles(table.column("text"), size)
        return ballots.Keys(*_bucket(value, buckets)).rows(table.column("batch")[0].as_py())
    return run


def shared_tokens(size, percent, buckets, id_type):
    """Rows of a batch: id, set size, node, and the shared tokens of the first text of each node."""
    def run(table, answers):
        release()
        if not table.num_rows:
            return pa.table([pa.array([], id_type), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))],
                            names=["id", "n", "node", "tokens"])
        texts, text, value = _shingles(table.column("text"), size)
        bucket, key = _bucket(value, buckets)
        keys = ballots.Keys(bucket, key)
        yes = keys.answered(ballots.by_kind(answers, 0))
        code = lambda b, k: (b.astype(np.uint64) << np.uint64(32)) | k.astype(np.uint64)
        shared = ballots._in(code(bucket, key), code(keys.bucket[yes], keys.key[yes]))
        n = np.bincount(text, minlength=texts)
        m = np.bincount(text[shared], minlength=texts)
        print_ = np.zeros(texts, np.uint64)
        with np.errstate(over="ignore"):
            at = np.flatnonzero(n)
            if len(at):
                print_[at] = np.add.reduceat(mixed(value, 21), (np.cumsum(n) - n)[at])
            print_ = mixed(print_ + n.astype(np.uint64), 22)
        kept = (n > 0) & (100 * m >= percent * n)
        node = pa.array(print_.view(np.int64), mask=~kept)
        first = np.zeros(texts, bool)
        candidates = np.flatnonzero(kept)
        first[candidates[np.unique(print_[candidates], return_index=True)[1]]] = True
        taken = shared & first[text]
        offsets = np.concatenate([[0], np.cumsum(np.where(first, m, 0))]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[taken].view(np.int64)))
        return pa.table([table.column("id").combine_chunks(), pa.array(n, pa.int64()), node, tokens], names=["id", "n", "node", "tokens"])
    return run


def _csr(column):
    """Values and lengths of a list<long> column."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return arr.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.diff(arr.offsets.to_numpy())


def _overlaps(left, left_n, right, right_n, width=4096):
    """Sizes of all intersections of two bounded lists of sets, by products of 0/1 matrices over slices of the tokens."""
    vocabulary = np.intersect1d(left, right)
    out = np.zeros((len(left_n), len(right_n)), np.int64)

    def cells(values, lengths):
        row = np.repeat(np.arange(len(lengths)), lengths)
        col = np.minimum(np.searchsorted(vocabulary, values), max(len(vocabulary) - 1, 0))
        ok = vocabulary[col] == values if len(vocabulary) else np.zeros(len(values), bool)
        row, col = row[ok], col[ok]
        order = np.argsort(col, kind="stable")
        return row[order], col[order]

    (a_row, a_col), (b_row, b_col) = cells(left, left_n), cells(right, right_n)
    for start in range(0, len(vocabulary), width):
        parts = []
        for row, col, n in ((a_row, a_col, len(left_n)), (b_row, b_col, len(right_n))):
            i, j = np.searchsorted(col, [start, start + width])
            m = np.zeros((n, min(width, len(vocabulary) - start)), np.float32)
            m[row[i:j], col[i:j] - start] = 1
            parts.append(m)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out


def _linked(overlap, n, m, percent):
    return 100 * overlap >= percent * (n[:, None] + m[None, :] - overlap)


def link_block(percent):
    """Links inside a block: each node with the least node of its component there."""
    def run(table):
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        values, lengths = _csr(table.column("tokens"))
        # tokens seen once in the block link nothing
        order = np.sort(values)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        keep = ballots._in(values, twice)
        lengths = np.bincount(np.repeat(np.arange(len(n)), lengths)[keep], minlength=len(n))
        values, root = values[keep], np.arange(len(n))
        first = np.concatenate([[0], np.cumsum(lengths)])
        for i in range(0, len(n), BLOCK):
            for j in range(i, len(n), BLOCK):
                a, b = slice(first[i], first[min(i + BLOCK, len(n))]), slice(first[j], first[min(j + BLOCK, len(n))])
                hit = _linked(_overlaps(values[a], lengths[i:i + BLOCK], values[b], lengths[j:j + BLOCK]), n[i:i + BLOCK], n[j:j + BLOCK], percent)
                for x, y in zip(*np.nonzero(hit)):
                    x, y = x + i, y + j
                    while root[x] != x:
                        x = root[x] = root[root[x]]
                    while root[y] != y:
                        y = root[y] = root[root[y]]
                    if x != y:
                        root[max(x, y)] = min(x, y)
        for i in range(len(root)):
            root[i] = root[root[i]]
        return pa.table([pa.array(node[root != np.arange(len(n))], pa.int64()), pa.array(node[root[root != np.arange(len(n))]], pa.int64())], names=["a", "b"])
    return run


def _attach(table, labels):
    """Component of each node of a batch."""
    node = table.column("node").to_numpy()
    known, value = labels.column("node").to_numpy(), labels.column("component").to_numpy()
    if not len(known):
        return node.copy()
    order = np.argsort(known)
    known, value = known[order], value[order]
    at = np.minimum(np.searchsorted(known, node), len(known) - 1)
    return np.where(known[at] == node, value[at], node)


def _foreign_keys(table, labels, buckets):
    values, lengths = _csr(table.column("tokens"))
    component = _attach(table, labels)
    return values, lengths, component, *_bucket(values, buckets), np.repeat(component, lengths)


def _distinct_pairs(bucket, key, component):
    order = np.lexsort((component, key, bucket))
    b, k, c = bucket[order], key[order], component[order]
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return b[new], k[new], c[new]


def send_components(buckets):
    """Distinct (token, component) of a batch of nodes, packed by bucket."""
    def run(table, labels):
        release()
        out = []
        if table.num_rows:
            *_, bucket, key, component = _foreign_keys(table, labels, buckets)
            b, k, c = _distinct_pairs(bucket, key, component)
            edge = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else []
            for i, j in zip(edge, np.append(edge[1:], len(b)) if len(b) else []):
                out.append((int(b[i]), k[i:j].tobytes() + c[i:j].tobytes(), int(j - i)))
        batch = table.column("batch")[0].as_py() if table.num_rows else 0
        return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([batch] * len(out), pa.int32()),
                         pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int64())],
                        names=["bucket", "batch", "body", "n"])
    return run


def judge_components(table):
    """Which of the tokens sent by each batch occur in more than one component?"""
    bodies, sizes = [b.as_buffer() for b in table.column("body")], table.column("n").to_pylist()
    keys = [np.frombuffer(b, np.uint32, n) for b, n in zip(bodies, sizes)]
    owners = [np.frombuffer(b, np.int64, n, 4 * n) for b, n in zip(bodies, sizes)]
    all_keys, all_owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(all_keys, kind="stable")
    k, c = all_keys[order], all_owners[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    yes = k[at][np.minimum.reduceat(c, at) != np.maximum.reduceat(c, at)]
    out = [(batch, ballots._in(part, yes)) for batch, part in zip(table.column("batch").to_pylist(), keys)]
    out = [(batch, np.packbits(bits).tobytes()) for batch, bits in out if bits.any()]
    bucket = table.column("bucket")[0].as_py()
    return pa.table([pa.array([r[0] for r in out], pa.int32()), pa.array([0] * len(out), pa.int32()), pa.array([bucket] * len(out), pa.int32()),
                     pa.array([r[1] for r in out], pa.binary())], names=["batch", "kind", "bucket", "body"])


def foreign_nodes(percent, buckets):
    """Nodes of which enough tokens occur in other components, with these tokens; `answers` holds labels too."""
    def run(table, mail):
        release()
        names = ["node", "component", "n", "tokens"]
        if not table.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.list_(pa.int64()))], names=names)
        is_label = np.array(mail.column("kind").to_pylist(), np.int64) == 1
        labels = mail.filter(pa.array(is_label))
        values, lengths, component, bucket, key, owner = _foreign_keys(table, labels, buckets)
        b, k, _ = _distinct_pairs(bucket, key, owner)
        bits, answers = np.zeros(len(b), bool), ballots.by_kind(mail, 0)
        edge = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else []
        for i, j in zip(edge, np.append(edge[1:], len(b)) if len(b) else []):
            if int(b[i]) in answers:
                bits[i:j] = np.unpackbits(np.frombuffer(answers[int(b[i])], np.uint8), count=j - i).view(bool)
        code = lambda b, k: (b.astype(np.uint64) << np.uint64(32)) | k.astype(np.uint64)
        keep = ballots._in(code(bucket, key), np.unique(code(b[bits], k[bits])))
        n = table.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), lengths)
        m = np.bincount(row[keep], minlength=len(n))
        good = 100 * m >= percent * n
        taken = keep & good[row]
        offsets = np.concatenate([[0], np.cumsum(m[good])]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[taken].view(np.int64)))
        return pa.table([pa.array(table.column("node").to_numpy()[good]), pa.array(component[good]), pa.array(n[good]), tokens], names=names)
    return run


def open_groups(percent):
    """Edges between components from the queries that reach a group: bound on the union first, then its members."""
    def run(queries, members):
        release()
        names = ["a", "b"]
        if not queries.num_rows or not members.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2, names=names)
        (q, q_len), (m, m_len) = _csr(queries.column("tokens")), _csr(members.column("m_tokens"))
        qn, mn = queries.column("n").to_numpy(), members.column("m_n").to_numpy()
        row = np.repeat(np.arange(len(qn)), q_len)
        inside = ballots._in(q, np.unique(m))
        bound = np.bincount(row[inside], minlength=len(qn))
        least = mn.min()
        opened = (100 * bound >= percent * np.maximum(qn, least)) & ((100 + percent) * bound >= percent * (qn + least))
        q_len = np.bincount(row[opened[row]], minlength=len(qn))[opened]
        hit = _linked(_overlaps(q[opened[row]], q_len, m, m_len), qn[opened], mn, percent)
        a = queries.column("component").to_numpy()[opened]
        x, y = np.nonzero(hit)
        pairs = np.unique(np.stack([a[x], members.column("m_component").to_numpy()[y]]), axis=1) if len(x) else np.zeros((2, 0), np.int64)
        return pa.table([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=names)
    return run


def _dealt(df, key, column, slots):
    """Split each `key` into ceil(count / slots) parts by a hash of the node; adds the part as `column`."""
    sizes = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / slots).alias("parts")).filter("parts > 1")
    return (df.join(sizes, key, "left")
            .withColumn(column, F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("node", key), F.col("parts"))).cast("int")).drop("parts"))


def matrix_links(rest, percent):
    """Links between different components among `rest` (node, component, n, tokens), by the token-group matrix.

    Groups are nodes of one least token, in parts of bounded size. Of two components the one that is less by (size,
    number) asks, so a group is asked only by nodes of less components than its greatest.
    """
    sizes = rest.groupBy("component").agg(F.count(F.lit(1)).alias("csize"))
    least = F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(3)))).alias("key")
    placed = _dealt(rest.select("node", "component", least).join(sizes, "component"), "key", "part", BLOCK)
    placed = placed.select("node", F.struct("csize", "component").alias("rank"), F.xxhash64("key", "part").alias("group"))
    rest = materialize(rest.join(placed, "node"), "groups")
    tops = rest.groupBy("group").agg(F.max("rank").alias("top"))
    cells = rest.select("group", F.explode("tokens").alias("token")).distinct()
    weight = cells.groupBy("token").agg(F.count(F.lit(1)).alias("groups"))
    spare = F.expr(f"n - CAST(ceil({percent} * n / 100) AS INT) - (n - size(tokens)) + 1")
    prefix = (rest.select("node", "rank", spare.alias("probes"), F.explode("tokens").alias("token")).join(weight, "token")
              .groupBy("node", "rank", "probes").agg(F.array_sort(F.collect_list(F.struct("groups", "token"))).alias("order"))
              .select("node", "rank", F.explode(F.expr("transform(slice(order, 1, CAST(probes AS INT)), x -> x.token)")).alias("token")))
    there = cells.join(tops, "group").select("group", "top", F.col("token").alias("cell"))
    found = prefix.join(there, (prefix.token == there.cell) & (prefix.rank < there.top)).select("node", "group").distinct()
    found = materialize(_dealt(found, "group", "slot", 4 * BLOCK), "found")
    asked = found.join(rest.select("node", "component", "n", "tokens"), "node")
    asked = asked.select(F.col("group").alias("q_group"), F.col("slot").alias("q_slot"), "component", "n", "tokens")
    members = rest.select("group", F.col("component").alias("m_component"), F.col("n").alias("m_n"), F.col("tokens").alias("m_tokens"))
    offered = found.select("group", "slot").distinct().join(members, "group")
    return asked.groupBy("q_group", "q_slot").cogroup(offered.groupBy("group", "slot")).applyInArrow(open_groups(percent), "a long, b long")


def components(docs, id="doc_id", text="text", shingle=5, percent=80):
    """One row per row of `docs`: its id, n_shingles (long), component_id.

    A-Z are lowered; words are runs of bytes other than ASCII white space; a document's set holds its distinct
    `shingle`-word shingles, a shorter text being one shingle. Rows are linked when
    100 * intersection >= percent * union; component_id is the least id that links reach. A null or empty text has
    an empty set and is linked with nothing. Repeated rows are linked like any equal texts. A null id takes part
    and counts last for the least; an empty table gives an empty one. Sets are compared on 64-bit hashes.
    Columns other than `id` and `text` are not looked at.
    """
    common.ship("unitgrid.llm.ballots", __name__)
    spark = docs.sparkSession
    parts = common.partitions(spark)
    batches, buckets = common.portions(docs, text)
    kind = docs.schema[id].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    packed = docs.select(F.pmod(F.xxhash64(common.quoted(text), common.quoted(id)), F.lit(batches)).cast("int").alias("batch"),
                         common.quoted(id).alias("id"), common.quoted(text).alias("text")).repartition(parts, "batch")
    shared = (packed.groupBy("batch").applyInArrow(send_tokens(shingle, buckets), ballots.SENT)
              .groupBy("bucket").applyInArrow(ballots.judge(0, np.uint32, False), ballots.ANSWER))
    rows = materialize(packed.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        shared_tokens(shingle, percent, buckets, to_arrow_type(kind)), f"id {kind.simpleString()}, n long, node long, tokens array<long>"), "sets")

    nodes = rows.filter("node IS NOT NULL AND size(tokens) > 0").select("node", "n", "tokens").dropDuplicates(["node"])
    nodes = materialize(nodes.withColumn("batch", F.pmod("node", F.lit(batches)).cast("int")), "nodes")
    least = lambda seed: F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(seed)))).alias("key")
    blocks = None
    for seed in (1, 2):
        keyed = _dealt(nodes.select("node", least(seed)).withColumn("seed", F.lit(seed)), "key", "part", BLOCK)
        blocks = keyed if blocks is None else blocks.unionByName(keyed)
    lone = placed = materialize(blocks, "blocks")
    meet = lone.groupBy("seed", "key", "part").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    lone = lone.join(meet, ["seed", "key", "part"])
    links = (lone.join(nodes.select("node", "n", "tokens"), "node").select("seed", "key", "part", "node", "n", "tokens")
             .groupBy("seed", "key", "part").applyInArrow(link_block(percent), "a long, b long"))
    links = materialize(links, "links")
    labels = connected(links)
    discard(placed, links)

    mail = labels.select(F.pmod("node", F.lit(batches)).cast("int").alias("batch"), F.lit(1).alias("kind"), F.lit(0).alias("bucket"),
                         F.lit(None).cast("binary").alias("body"), "node", "component")
    dealt = nodes.repartition(parts, "batch")
    answers = (dealt.groupBy("batch").cogroup(mail.groupBy("batch")).applyInArrow(send_components(buckets), ballots.SENT)
               .groupBy("bucket").applyInArrow(judge_components, ballots.ANSWER))
    mail = mail.unionByName(answers, allowMissingColumns=True)
    rest = materialize(dealt.groupBy("batch").cogroup(mail.groupBy("batch")).applyInArrow(
        foreign_nodes(percent, buckets), "node long, component long, n long, tokens array<long>"), "rest")
    more = materialize(matrix_links(rest, percent), "more")
    joined = connected(more)
    discard(nodes, rest, more)
    labels = (labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "full")
              .select(F.coalesce("node", "component").alias("node"), F.coalesce("top", "component").alias("component")))
    final = labels.unionByName(joined).groupBy("node").agg(F.min("component").alias("component"))

    inside = rows.filter("node IS NOT NULL")
    owners = inside.groupBy("node").agg(F.min("id").alias("id")).join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    tops = owners.groupBy("component").agg(F.min("id").alias("component_id"))
    tops = materialize(owners.join(tops, "component").select("node", "component_id"), "tops")
    named = inside.select("id", "n", "node").join(tops, "node").select("id", "n", "component_id")
    alone = rows.filter("node IS NULL").select("id", "n", F.col("id").alias("component_id"))
    done = materialize(named.unionByName(alone).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id"), "groups")
    discard(rows, tops)
    return done
