"""Merkle manifest: every row a leaf, a tree per group, a tree over the groups' roots, siblings that prove each leaf.

Method: concatenated-level strings. Leaves are ranked in their group by a range sort and dealt into aligned blocks of
`WIDTH ** DEPTH` places. A block keeps each of its levels as one string of 64 hex digits a node; parents are hashes of
fixed-width substrings of it, and the siblings of a node are the substrings that flank it in its run. A block ends in one
node, and the nodes of all blocks are the leaves of the next round, so that a group of any size takes log rounds and no
task sees more than one block of it. The roots of the groups, in order, go through the same rounds.
"""

from pyspark.sql import functions as F

from unitgrid.llm import common
from unitgrid.operators.ordering import rank_in_groups, rank_rows
from unitgrid.session import discard, materialize

WIDTH, DEPTH, HEX = 3, 5, 64
SEGMENTS = "array<struct<left:string,right:string>>"


def hashed(column):
    return F.sha2(column, 256)


def leaf_of(*values):
    """Hash of the fields of a row: `-` for null, else the number of UTF-8 bytes, `:` and the value as text."""
    text = [v.cast("string") for v in values]
    return hashed(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))


def fold(leaf, siblings):
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, leaf, lambda node, s: hashed(F.concat(s["left"], node, s["right"])))


def proof(siblings):
    """All siblings of a leaf in one string, level by level, left to right."""
    return F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), "")


def _levels(level, block):
    """Level strings of a block, from its nodes to the one node it ends in.

    A group of one block stops at one node. Blocks of larger groups take all rounds, the last and shorter one too; a full
    first block needs them anyway, so no block has to know how many others its group has.
    """
    def parents(s):
        runs = F.ceil(F.length(s) / F.lit(HEX * WIDTH)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: hashed(F.substr(s, i * (HEX * WIDTH) + 1, F.lit(HEX * WIDTH)))), "")

    def higher(levels, _):
        last = F.element_at(levels, -1)
        return F.when((block > 0) | (F.length(last) > HEX), F.concat(levels, F.array(parents(last)))).otherwise(levels)

    return F.aggregate(F.array(*[F.lit(i) for i in range(DEPTH)]), F.array(level), higher)


def _siblings(levels, offset):
    """Left and right siblings of the node at `offset`, for each level of its block but the last."""
    steps = F.array(*[F.lit(WIDTH ** k) for k in range(DEPTH)])

    def segment(s, k):
        at = F.floor(offset / F.element_at(steps, k + 1)).cast("int")
        place = at % WIDTH
        return F.struct(F.substr(s, (at - place) * HEX + 1, place * HEX).alias("left"),
                        F.substr(s, (at + 1) * HEX + 1, (F.lit(WIDTH - 1) - place) * HEX).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), segment)


def _rounds(nodes):
    """Blocks of each round, written: (grp, block, nodes sorted by place, levels). `nodes`: (grp, pos, digest, row)."""
    rounds = []
    while True:
        size = WIDTH ** DEPTH
        blocks = (nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "row"))).alias("nodes")))
        level = F.array_join(F.transform("nodes", lambda n: n["digest"]), "")
        blocks = materialize(blocks.withColumn("levels", _levels(level, F.col("block"))), "merkle")
        rounds.append(blocks)
        if not (blocks.agg(F.max("block")).first()[0] or 0):
            return rounds
        nodes = blocks.select("grp", F.col("block").alias("pos"), F.element_at("levels", -1).alias("digest"), F.lit(None).cast("string").alias("row"))


def _ends(rounds):
    """(grp, top): the node in which each group ends."""
    return rounds[-1].select("grp", F.element_at("levels", -1).alias("top"))


def _down(rounds, tops):
    """(grp, row, digest, siblings, and the other columns of tops) of all nodes of the first round.

    `tops`: (grp, up, ...) with the siblings `up` that follow after a group's own.
    """
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    others = [c for c in tops.columns if c not in ("grp", "up")]
    for blocks in reversed(rounds):
        joined = blocks.join(above.withColumnRenamed("pos", "block"), ["grp", "block"])
        nodes = joined.select("grp", "block", "levels", "up", *others, F.explode("nodes").alias("n"))
        offset = (F.col("n.pos") - F.col("block") * (WIDTH ** DEPTH)).cast("int")
        above = nodes.select("grp", F.col("n.pos").alias("pos"), F.col("n.row").alias("row"), F.col("n.digest").alias("digest"),
                             F.concat(_siblings(F.col("levels"), offset), "up").alias("up"), *others)
        if blocks is not rounds[0]:
            above = above.drop("row", "digest")
    return above.withColumnRenamed("up", "siblings")


def manifest(rows, leaf, group="source", order="doc_id", carry=()):
    """Leaf, siblings, subroot and root of every row.

    `leaf` is a column expression (see `leaf_of`). Returns group, order, leaf, siblings (array of left and right, from the
    leaf's own level to the root's), subroot, root and the columns named in `carry`; other columns are not looked at, so
    their names clash with nothing. Leaves of a group ascend by `order`, nulls first, ties by leaf; rows with equal order
    and leaf are leaves each. Groups ascend bytewise, null first; a null group is a group. Groups of one leaf have that
    leaf as subroot, one group has its subroot as root. An empty table gives an empty one. A group of any size is spread
    over all tasks: what meets in one task are the 243 nodes of a block.
    """
    q = common.quoted
    kept = F.struct(q(group).alias("group"), q(order).alias("order"), *[q(c).alias(f"c{i}") for i, c in enumerate(carry)])
    # a null group sorts before all others and is a key like them
    leaves = rows.select(F.coalesce(F.concat(F.lit(":"), q(group).cast("string")), F.lit("")).alias("grp"), leaf.alias("digest"), kept.alias("row"))
    ranked = rank_in_groups(leaves, ["grp"], [F.col("row.order").asc_nulls_first(), F.col("digest"), F.col("row")])
    nodes = ranked.select("grp", (F.col("rank") - 1).alias("pos"), "digest", "row")
    rounds = _rounds(nodes)
    subroots = rank_rows(_ends(rounds).withColumnRenamed("top", "subroot"), ["grp"], "rank")
    above = _rounds(subroots.select(F.lit("").alias("grp"), (F.col("rank") - 1).alias("pos"), F.col("subroot").alias("digest"), F.col("grp").alias("row")))
    root = _ends(above).select("grp", F.col("top").alias("root"), F.array().cast(SEGMENTS).alias("up"))
    tops = materialize(_down(above, root).select(F.col("row").alias("grp"), F.col("digest").alias("subroot"), "root", F.col("siblings").alias("up")), "subroots")
    discard(*above)
    out = _down(rounds, tops)
    return out.select(F.col("row.group").alias(group), F.col("row.order").alias(order), F.col("digest").alias("leaf"), "siblings", "subroot", "root",
                      *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)])
