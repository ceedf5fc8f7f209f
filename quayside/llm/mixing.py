"""Mixing sources to target weights, by budgets that pass down a tree and prefixes of seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.marks import Shield
from quayside.session import settle

#: Weights are whole numbers; budgets and products of them are exact decimals.
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Level:
    """One level of the tree: the SQL expression of a row's node, and the weights of nodes among their siblings.

    A node without a weight of its own has ``default``; weight 0 leaves it out. Weights are whole numbers. A null node is a
    node like any other, with the default weight.
    """

    name: str
    node: str
    weights: Mapping[str, int] = field(default_factory=dict)
    default: int = 1

    def weight(self, node: Column) -> Column:
        found = F.lit(self.default)
        for value, weight in sorted(self.weights.items()):
            found = F.when(node == value, weight).otherwise(found)
        return found.cast(EXACT)


def word_count(text: Column) -> Column:
    """Tokens of a text: its runs of characters other than ASCII white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def whole_parts(number: Column, by: Column) -> Column:
    """Integer quotient; a decimal quotient would be rounded before it could be cut off."""
    return F.call_function("div", number.cast(EXACT), by.cast(EXACT))


def share_out(children: DataFrame, siblings: Sequence[str]) -> DataFrame:
    """Adds ``quota`` to nodes with ``weight``, ``supply`` and the ``budget`` of their parent, which stands in every sibling.

    Every node gets its share by weight, or its supply if that is less; what the short ones leave goes to the other siblings by
    weight. A node is short if it is, with all nodes that run short before it, below the share that is then left: nodes are
    looked at by supply per weight. Shares are rounded down, so less than one token for each sibling stays unused. Nodes without
    weight or supply get none.
    """
    active = (F.col("weight") > 0) & (F.col("supply") > 0)
    ratio = F.when(active, F.col("supply").cast("double") / F.col("weight").cast("double"))
    group = Window.partitionBy(*siblings)
    order = group.orderBy(F.col("ratio").asc_nulls_last(), F.col("node").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.when(F.col("ratio").isNotNull(), F.col("weight")).otherwise(F.lit(0).cast(EXACT))

    def total(value: Column, frame) -> Column:
        return F.coalesce(F.sum(value).over(frame), F.lit(0)).cast(EXACT)

    shares = (
        children.withColumn("ratio", ratio)
        .withColumn("w", weight)
        .withColumn("taken", total(F.when(F.col("ratio").isNotNull(), F.col("supply")), before))
        .withColumn("left_weight", total(F.col("w"), onward))
    )
    short = F.col("ratio").isNotNull() & (
        (F.col("supply") * F.col("left_weight")).cast(EXACT) <= ((F.col("budget") - F.col("taken")) * F.col("w")).cast(EXACT)
    )
    marked = shares.withColumn("short", short)
    # Nodes run short in order: the first one that does not ends the row of short ones.
    marked = marked.withColumn("short", F.min("short").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = marked.withColumn("used", total(F.when(F.col("short"), F.col("supply")), group)).withColumn(
        "rest", total(F.when(~F.col("short"), F.col("w")), group)
    )
    open_share = F.when(F.col("rest") > 0, whole_parts((F.col("budget") - F.col("used")) * F.col("w"), F.col("rest")))
    quota = F.when(F.col("ratio").isNull(), 0).when(F.col("short"), F.col("supply")).otherwise(open_share)
    return marked.withColumn("quota", quota.cast(EXACT)).drop("ratio", "w", "taken", "left_weight", "short", "used", "rest")


def leaf_budgets(supplies: DataFrame, levels: Sequence[Level], budget: Column, epochs: int) -> DataFrame:
    """``names..., rows, supply, quota`` of each leaf; ``supplies`` has one row per leaf with ``rows`` and ``tokens``.

    A leaf can give its tokens ``epochs`` times. A node's supply is that of its leaves, and budgets pass down from the root.
    What a leaf lacks therefore goes to its siblings first; only what a whole subtree lacks reaches the siblings above.
    The tables here have a row for each node, not for each document.
    """
    names = [level.name for level in levels]
    leaves = supplies.withColumn("supply", (F.col("tokens") * epochs).cast(EXACT))
    able = F.lit(True)
    for level in levels:
        able = able & (level.weight(F.col(level.name)) > 0)
    leaves = settle(leaves.withColumn("supply", F.when(able, F.col("supply")).otherwise(F.lit(0).cast(EXACT))), "leaves")
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).cast(EXACT).alias("all")).scalar()
    parents = None
    for depth, level in enumerate(levels):
        above, here = names[:depth], names[: depth + 1]
        nodes = leaves.groupBy(*here).agg(F.sum("supply").cast(EXACT).alias("supply"))
        nodes = nodes.withColumn("weight", level.weight(F.col(level.name))).withColumn("node", F.col(level.name))
        if parents is None:
            nodes = nodes.withColumn("budget", F.least(budget.cast(EXACT), total))
        else:
            same = [nodes[n].eqNullSafe(parents[n]) for n in above]
            nodes = nodes.join(parents, same).select(*[nodes[c] for c in nodes.columns], parents["quota"].alias("budget"))
        parents = settle(share_out(nodes, above).select(*here, "quota"), "budgets")
    same = [leaves[n].eqNullSafe(parents[n]) for n in names]
    return leaves.join(parents, same).select(*[leaves[n] for n in names], "rows", "tokens", "quota")


def epoch_key(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a document in an epoch: documents are taken in the order of this hash."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def _bucket(place: Column, buckets: Column) -> Column:
    """Which of ``buckets`` equal parts of all hashes a hash lies in; ascending with the hash."""
    return F.floor(F.conv(F.substring(place, 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long")


def _cuts(rows: DataFrame, leaves: DataFrame, names: Sequence[str], seed: int) -> DataFrame:
    """Leaves with ``cut``: the last hash that the leaf's last, partial epoch takes.

    A running sum over a leaf's documents would put a hot leaf into one task. Instead a leaf of n rows is summed in about the
    root of n parts of the hash range, the part where the quota ends is found, and only that part is summed row by row.
    """
    same = [F.col(f"r.{n}").eqNullSafe(F.col(f"l.{n}")) for n in names]
    wanted = leaves.where("rest > 0")
    placed = (
        rows.alias("r")
        .join(wanted.alias("l"), same)
        .select(*[F.col(f"l.{n}").alias(n) for n in names], "r.tokens", "l.rest", "l.buckets", epoch_key(seed, F.col("l.whole") + 1, F.col("r.key")).alias("place"))
        .withColumn("bucket", _bucket(F.col("place"), F.col("buckets")))
    )
    group = [*names, "bucket"]
    sums = placed.groupBy(*group).agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("tokens").over(upto))
    ends = settle(
        sums.where("upto >= rest AND upto - tokens < rest").select(*names, "bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("lacks")),
        "ends",
    )
    same = [F.col(f"p.{n}").eqNullSafe(F.col(f"e.{n}")) for n in group]
    inside = placed.alias("p").join(ends.alias("e"), same).groupBy(*[F.col(f"e.{n}").alias(n) for n in names], "p.place", "e.lacks").agg(F.sum("p.tokens").alias("tokens"))
    upto = Window.partitionBy(*names).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.withColumn("upto", F.sum("tokens").over(upto)).where("upto >= lacks AND upto - tokens < lacks")
    return last.select(*names, F.col("place").alias("cut"))


def mix_plan(docs: DataFrame, levels: Sequence[Level], budget_share: float, epochs: int, seed: int, text: str, key: str) -> DataFrame:
    """``names..., whole, cut`` of each leaf that gives anything: whole epochs, and the last hash of a partial one.

    The budget is ``budget_share`` of the tokens of one pass over the whole corpus.
    """
    names = [level.name for level in levels]
    rows = settle(
        docs.select(*[F.expr(level.node).alias(level.name) for level in levels], F.col(key).alias("key"), word_count(F.col(text)).alias("tokens")), "sizes"
    )
    supplies = settle(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens")), "supplies")
    budget = supplies.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(budget_share)).alias("b")).scalar()
    leaves = leaf_budgets(supplies, levels, budget, epochs).where("quota > 0")
    whole = whole_parts(F.col("quota"), F.col("tokens"))
    leaves = settle(
        leaves.withColumn("whole", whole)
        .withColumn("rest", (F.col("quota") - F.col("whole") * F.col("tokens")).cast("long"))
        .withColumn("buckets", F.ceil(F.sqrt("rows")).cast("long")),
        "leaves",
    )
    cuts = settle(_cuts(rows, leaves, names, seed), "cuts")
    same = [F.col(f"l.{n}").eqNullSafe(F.col(f"c.{n}")) for n in names]
    plan = leaves.alias("l").join(cuts.alias("c"), same, "left").select(*[F.col(f"l.{n}").alias(n) for n in names], "l.whole", "c.cut")
    return settle(plan, "plan")


def mix(
    docs: DataFrame,
    levels: Sequence[Level],
    budget_share: float = 0.6,
    epochs: int = 2,
    seed: int = 7,
    text: str = "text",
    key: str = "doc_id",
    told: bool = True,
) -> DataFrame:
    """``docs`` as often as the mixture takes them, with ``mix_epoch`` and ``mix_key`` and, as ``mix_`` and its name, each level.

    These replace columns already called so; without ``told`` none is added, and all columns keep their values.

    Each leaf takes whole epochs of its documents and then, from one more epoch in seeded order, documents until its quota of
    tokens is reached; the document that reaches it is taken whole. Documents without tokens go with every epoch, and into a
    partial one if they come before its end. Rows with one key have one place in the order and are taken or left together;
    null keys count as one key. Null nodes form leaves of their own. An empty table gives no rows. The texts are not shuffled:
    a small row per leaf, with the last hash it takes, decides about each document where it is read.
    """
    names = [level.name for level in levels]
    plan = mix_plan(docs, levels, budget_share, epochs, seed, text, key)
    held = Shield(docs, **{f"mix_{level.name}": F.expr(level.node) for level in levels})
    key_ = F.col(held.inner_name(key))
    same = [F.col(f"d.mix_{n}").eqNullSafe(F.col(f"p.{n}")) for n in names]
    found = held.inner.alias("d").join(plan.alias("p"), same).select("d.*", F.col("p.whole").alias("taken_whole"), F.col("p.cut").alias("taken_cut"))
    last = F.coalesce(epoch_key(seed, F.col("taken_whole") + 1, key_) <= F.col("taken_cut"), F.lit(False))
    taken = found.withColumn("taken_last", F.col("taken_whole") + last.cast("long")).where("taken_last > 0")
    taken = taken.withColumn("taken_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken_last"))))
    if not told:
        return held.restored(taken, {})
    shown = {f"mix_{n}": F.col(f"mix_{n}") for n in names}
    return held.restored(taken, {}, {**shown, "mix_epoch": F.col("taken_epoch"), "mix_key": epoch_key(seed, F.col("taken_epoch"), key_)})
