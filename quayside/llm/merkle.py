"""Merkle manifest of a dataset: levels of a hash tree as concatenated strings of fixed-width digests.

The rows of a group (a language, a source) are the leaves of a tree in key order, and the group roots are the leaves of one
more tree. A tree is worked off in aligned blocks of ``BLOCK`` nodes: a block keeps each of its levels as one hex string, parents
are hashes of fixed-width substrings of it, and the siblings of a node are the substrings on either side in its run. The
tops of the blocks are the nodes of the next, shorter round. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.matching import is_small, small_side
from quayside.operators.ordering import PART, in_order, join_same, number_ordered
from quayside.session import settle

#: Hex digits of a digest.
WIDTH = 64
#: Children of a node, and levels that a block covers; a block holds ``FAN ** DEPTH`` nodes at most.
FAN, DEPTH = 2, 7
BLOCK = FAN**DEPTH
_GROUP, _AT, _COUNT, _HASH, _BLOCK = "tree_group", "tree_at", "tree_count", "tree_hash", "tree_block"
_SIBLINGS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """Digest of a row."""
    return digest(*map(field, fields))


def fold(found: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(siblings, found, lambda h, s: digest(s["before"], h, s["after"]))


def _piece(level: Column, first: Column, last: Column) -> Column:
    """Digests ``first`` to ``last`` (exclusive, 0-based) of a level; beyond its end there are none."""
    return F.substr(level, first * WIDTH + 1, (last - first) * WIDTH)


def _nodes(level: Column) -> Column:
    return F.floor(F.length(level) / WIDTH).cast("int")


def _above(level: Column) -> Column:
    """The next level: the digest of every run of ``FAN`` nodes; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.ceil(_nodes(level) / FAN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda r: digest(_piece(level, r * FAN, (r + 1) * FAN))), "")


def _siblings(levels: Column, at: Column) -> Column:
    """Segments on either side of a block's node in its run, for each level below the top."""

    def flank(level: Column, depth: Column) -> Column:
        here = F.floor(at / F.pow(F.lit(FAN), depth)).cast("int")
        start = here - here % FAN
        return F.struct(_piece(level, start, here).alias("before"), _piece(level, here + 1, start + FAN).alias("after"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), flank)


def blocks_of(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``tree_group, tree_block, tree_count, levels, members``: the aligned blocks of ``nodes``.

    A node has its group, its place there from 0, the number of nodes of its group and its digest; ``members`` keeps the
    columns ``carry`` of each node in order. A block covers ``DEPTH`` levels, or fewer if one node is left of the group. It holds
    ``BLOCK`` nodes at most, so that a group of any size is spread.
    """
    member = F.struct(_AT, _HASH, *[c for c in carry if c != _AT])
    gathered = (
        nodes.withColumn(_BLOCK, F.floor(F.col(_AT) / BLOCK).cast("long"))
        .groupBy(_GROUP, _BLOCK, _COUNT)
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
    )
    lowest = F.array(F.array_join(F.transform("members", lambda m: m[_HASH]), ""))
    # A level is followed by another if the whole group has more than one node on it.
    more = F.filter(F.array(*[F.lit(FAN**depth).cast("long") for depth in range(DEPTH)]), lambda covered: covered < F.col(_COUNT))
    levels = F.aggregate(more, lowest, lambda below, _: F.concat(below, F.array(_above(F.element_at(below, -1)))))
    return gathered.withColumn("levels", levels)


def _tops(blocks: DataFrame) -> DataFrame:
    """The nodes of the next round."""
    return blocks.select(
        _GROUP,
        F.col(_BLOCK).alias(_AT),
        F.ceil(F.col(_COUNT) / BLOCK).cast("long").alias(_COUNT),
        F.element_at("levels", -1).alias(_HASH),
    )


def rounds(nodes: DataFrame, carry: Sequence[str], label: str) -> list[DataFrame]:
    """The stored blocks of every round, ``BLOCK`` times fewer each; the last has one block for each group."""
    blocks = settle(blocks_of(nodes, carry), label)
    longest = blocks.agg(F.max(_COUNT)).first()[0] or 0
    return [blocks] if longest <= BLOCK else [blocks, *rounds(_tops(blocks), [_AT], label)]


def descend(levels: list[DataFrame], above: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``tree_group``, columns ``carry``, digest, ``subroot``, ``root`` and ``proof`` of every node of the first round.

    ``above`` has these of each group: what its root needs to get to the root of all. Each block takes what its top has,
    and its members put their own siblings in front.
    """
    blocks = levels[0]
    if len(levels) > 1:
        above = descend(levels[1:], above, [_AT]).withColumnRenamed(_AT, _BLOCK).drop(_HASH)
        joined = join_same(blocks, small_side(above), [_GROUP, _BLOCK])
    else:
        joined = join_same(blocks, small_side(above), [_GROUP])
    member = F.transform(
        "members",
        lambda m, i: F.struct(*[m[c].alias(c) for c in (_HASH, *carry)], F.concat(_siblings(F.col("levels"), i), F.col("proof")).alias("proof")),
    )
    return joined.select(_GROUP, "subroot", "root", F.explode(member).alias("member")).select(_GROUP, "subroot", "root", "member.*")


def placed(leaves: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``leaves`` with their place in the group (null is a group too) and the group's count, without one task for a hot group."""
    ordered = number_ordered(in_order(leaves, [_GROUP, *order_by], "leaves"), "tree_rn")
    # One row for each group and part of the order.
    runs = ordered.groupBy(_GROUP, PART).agg(F.min("tree_rn").alias("tree_first"), F.count(F.lit(1)).alias("tree_held"))
    sums = runs.groupBy(_GROUP).agg(F.min("tree_first").alias("tree_first"), F.sum("tree_held").alias(_COUNT))
    starts = settle(join_same(runs.select(_GROUP, PART), sums, [_GROUP]), "starts")
    joined = join_same(ordered, small_side(starts), [_GROUP, PART])
    return joined.withColumn(_AT, F.col("tree_rn") - F.col("tree_first")).drop("tree_rn", "tree_first", PART, "_position")


def _numbered(groups: DataFrame, name: str) -> DataFrame:
    """The group roots with their places in one tree; few are numbered in one task, more by ranges."""
    if not is_small(groups):
        return placed(groups, [name])
    whole = Window.partitionBy(_GROUP)
    places = F.row_number().over(whole.orderBy(F.asc_nulls_first(name))) - 1
    return groups.withColumn(_AT, places.cast("long")).withColumn(_COUNT, F.count(F.lit(1)).over(whole))


def manifest(docs: DataFrame, fields: Sequence[str], group: str = "lang", key: str = "doc_id", found: Column | None = None) -> DataFrame:
    """One row per document: ``key, group, leaf, subroot, root, proof, folded_root, verified``.

    ``leaf`` is the digest of ``fields``; the leaves of a group ascend by ``key`` (null first, ties by digest), and the group roots
    ascend by group (null first, bytewise). ``proof`` is the array of the siblings before and after, level by level from the leaf
    to the root. ``found`` is the digest of the row as it is met now, if it may have changed; ``folded_root`` is what it leads
    to with the siblings of the manifest, and ``verified`` says whether that is the root. Repeated rows are leaves each, null
    texts and keys count as null fields, an empty table gives no rows, a lone leaf is its own root, and other columns are
    ignored whatever they are called. Texts are read once and never moved.
    """
    whole = leaf(*[F.col(f"`{c}`") for c in fields])
    rows = docs.select(
        F.col(f"`{group}`").cast("string").alias(_GROUP), F.col(f"`{key}`").alias("tree_key"), whole.alias(_HASH), (whole if found is None else found).alias("tree_found")
    )
    nodes = placed(settle(rows, "rows"), ["tree_key", _HASH, "tree_found"])
    lower = rounds(nodes, ["tree_key", "tree_found"], "blocks")
    subroots = settle(lower[-1].select(F.col(_GROUP).alias("tree_name"), F.element_at("levels", -1).alias(_HASH)), "subroots")
    one = _numbered(subroots.withColumn(_GROUP, F.lit(None).cast("string")), "tree_name")
    upper = rounds(one, ["tree_name"], "upper")
    top = upper[-1].select(_GROUP, F.lit("").alias("subroot"), F.element_at("levels", -1).alias("root"), F.array().cast(_SIBLINGS).alias("proof"))
    above = descend(upper, top, ["tree_name"]).select(F.col("tree_name").alias(_GROUP), F.col(_HASH).alias("subroot"), "root", "proof")
    below = descend(lower, settle(above, "above"), ["tree_key", "tree_found"])
    folded = below.withColumn("folded_root", fold(F.col("tree_found"), F.col("proof")))
    return folded.select(
        F.col("tree_key").alias(key),
        F.col(_GROUP).alias(group),
        F.col(_HASH).alias("leaf"),
        "subroot",
        "root",
        "proof",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from left to right on each level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)
