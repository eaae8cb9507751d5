"""Mixing of sources to target weights by hierarchical budgets.

The documents form a tree (by default domain, language, source). A token budget at the root is
handed down level by level in proportion to the nodes' weights. No node gets more than its
capacity, the tokens below it times ``max_epochs``: what a child cannot take goes to its
siblings in proportion to their weights, and only what a whole family cannot take goes to the
family's own siblings, one level up. For one family this is a water level: children whose capacity per
weight lies below it are full, the others get level times weight. Sorting the children by
capacity per weight finds it from running sums.

A leaf that gets E whole epochs and a rest has each document E times, and a prefix of epoch E in
the order of a seeded hash: the longest prefix whose tokens fit the rest. Hash buckets with
their token sums show which bucket the prefix ends in, so only that bucket is ordered, however large the
leaf is.

Null levels are a node of their own; null or negative token counts are 0; rows that repeat are separate
rows. Weights that are missing are ``default``; a weight of 0 gets tokens only where no sibling can
take them (it then counts as a minute weight). An empty table gives no rows. All columns of the documents
are returned, and ``epoch`` (in place of a column of that name).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, stored

#: Hash buckets per leaf (12 of the 60 hash bits).
BUCKET_BITS = 12


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60-bit position of a document in an epoch: leading digits of md5('seed|epoch|doc_id')."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int | None,
                 max_epochs: int, default: int = 1) -> DataFrame:
    """``leaves`` (levels, tokens) with the tokens that each leaf is to give (``budget``).

    Every level's windows run over the children of one node.
    """
    nodes = leaves.withColumn("_cap", F.col("tokens") * max_epochs)
    top = F.sum("_cap").over(Window.partitionBy(F.lit(0)))  # one row per leaf
    share = F.sum("tokens").over(Window.partitionBy(F.lit(0))) if budget is None else F.lit(int(budget)).cast("long")
    nodes = nodes.withColumn("_got", F.least(share, top))
    for i, level in enumerate(levels):
        above, here = levels[:i], levels[:i + 1]
        named = F.create_map(*[F.lit(x) for kv in weights.get(level, {}).items() for x in kv]) if weights.get(level) else None
        w = F.lit(default) if named is None else F.coalesce(F.try_element_at(named, F.coalesce(F.col(level), F.lit(""))), F.lit(default))
        kids = (nodes.groupBy(*here).agg(F.sum("_cap").alias("_c"), F.first("_got").alias("_b"))
                .withColumn("_w", F.greatest(w.cast("double"), F.lit(1e-9))).withColumn("_r", F.col("_c") / F.col("_w")))
        fam = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = fam.orderBy("_r", F.col(level).asc_nulls_first())
        past = order.rowsBetween(Window.unboundedPreceding, -1)
        kids = (kids.withColumn("_level", (F.col("_b") - F.coalesce(F.sum("_c").over(past), F.lit(0)))
                                / F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
                # the first child, in this order, that is not filled sets the water level of its family
                .withColumn("_water", F.min(F.when(F.col("_r") >= F.col("_level"), F.struct("_r", F.col("_level").alias("v")))).over(fam)["v"])
                .withColumn("_got", F.when(F.col("_water").isNull(), F.col("_c"))
                            .otherwise(F.least(F.col("_c"), F.floor(F.col("_water") * F.col("_w") + 1e-6)).cast("long"))))
        nodes = _join(nodes.drop("_got"), kids.select(*here, "_got"), here)
    return nodes.select(*levels, "tokens", F.greatest(F.col("_got"), F.lit(0)).cast("long").alias("budget"))


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on null-safe keys; one row per key on the right."""
    r = right.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return left.join(r, on).drop(*[f"_k{i}" for i in range(len(keys))])


def mix(docs: DataFrame, levels: dict[str, Column], tokens: Column, weights: dict[str, dict[str, int]],
        budget: int | None = None, max_epochs: int = 4, seed: int = 7, id_col: str = "doc_id", default: int = 1) -> DataFrame:
    """Rows of ``docs`` chosen to meet the weights, with ``epoch`` (from 0).

    ``levels``: node name of each document from the root down (name -> column); ``weights``: per level,
    node name -> whole-number weight among its siblings. ``budget``: tokens in all (default: as many as
    ``docs`` has).
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "epoch"])
    cols = docs.columns
    names = fresh([*cols, "tokens", "budget", "epoch"], *[f"_level_{k}" for k in levels])
    size, eps, pos = fresh([*cols, *names, "tokens", "budget"], "_size", "_epochs", "_pos")
    inner = dict(zip(levels, names))
    kept = stored(docs.withColumns({**{inner[k]: c.cast("string") for k, c in levels.items()},
                                    size: F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0))}), "mixing")
    leaves = stored(kept.groupBy(*names).agg(F.sum(size).alias("tokens")), "mixing-leaves")
    plan = leaf_budgets(leaves, names, {inner[k]: v for k, v in weights.items()}, budget, max_epochs, default)
    # whole epochs, and what is left for a prefix of the next
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    plan = stored(plan.withColumn("_full", full).withColumn("_rest", F.col("budget") - F.col("_full") * F.col("tokens"))
                  .select(*names, "_full", "_rest"), "mixing-plan")
    placed = _join(kept, plan, names).withColumn(pos, order_hash(seed, F.col("_full"), F.col(f"`{id_col}`")))
    bucket = F.shiftright(F.col(pos), 60 - BUCKET_BITS)
    by = Window.partitionBy(*names).orderBy("_bucket")
    sums = (placed.where(F.col("_rest") > 0).groupBy(*names, bucket.alias("_bucket"))
            .agg(F.sum(size).alias("_s"), F.first("_rest").alias("_rest"))
            .withColumn("_upto", F.sum("_s").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    cut = (sums.where(F.col("_upto") > F.col("_rest")).groupBy(*names)
           .agg(F.min("_bucket").alias("_cut"), F.min_by(F.col("_rest") - F.col("_upto") + F.col("_s"), "_bucket").alias("_left")))
    cut = stored(cut, "mixing-cuts")
    whole = placed.where(F.col("_full") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("_full") - 1).cast("int"))))
    k = [f"_k{i}" for i in range(len(names))]
    on = F.lit(True)
    for a, b in zip(names, k):
        on = on & F.col(a).eqNullSafe(F.col(b))
    part = (placed.where(F.col("_rest") > 0).withColumn("epoch", F.col("_full").cast("int"))
            .join(cut.select(*[F.col(a).alias(b) for a, b in zip(names, k)], "_cut", "_left"), on, "left"))
    before = part.where(F.col("_cut").isNull() | (bucket < F.col("_cut")))
    row = Window.partitionBy(*names).orderBy(pos, F.col(f"`{id_col}`"), size).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = part.where(bucket == F.col("_cut")).withColumn(eps, F.sum(size).over(row)).where(F.col(eps) <= F.col("_left"))
    keep = [f"`{c}`" for c in cols] + ["epoch"]
    return whole.select(*keep).unionByName(before.select(*keep)).unionByName(edge.select(*keep))
