"""Mixing sources to target weights, by hierarchical budgets over a tree of three levels.

A token budget is shared out from the root: among the children of a node by weight, but to none more than all documents below it give in
``max_epochs`` passes. What a child cannot take goes to its siblings, by weight again; only what all of them cannot take
has already gone to the siblings of their parent, as a parent's room is that of its children together. The level at
which the water stands among siblings follows from running sums in the order of room over weight.

A leaf then takes whole passes over its documents, and of the next pass those that come first in a seeded order, as long as their
running total stays within the rest. The order is that of a hash of seed, pass and id. Its first three digits cut a leaf into 4,096
slices; sums of slices tell in which one the rest ends, and only the documents of that slice are ordered. So no
leaf, however large, meets in one task.

Everything is DataFrame functions. Texts are read to count words and do not move; documents are joined to the choice at the end.

Cases: a NULL or empty text has no tokens, and is taken if the running total allows it; NULL parts of the path count as empty names; equal
rows (id and text) are one document; documents whose hashes tie are ordered by their texts' hashes; a weight not given is 1, a
weight of 0 takes nothing; an empty table gives an empty result. Other columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecshoal.llm.common import kept_at, stored, text_key, whole
from vecshoal.llm.rules import words_of
from vecshoal.operators.joins import attach

LEVELS = ("l1", "l2", "l3")
SLICE_DIGITS = 3


def weight_of(weights: dict[str, float], name: str) -> Column:
    """The weight of a child by its own name."""
    if not weights:
        return F.lit(1.0)
    given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.element_at(given, F.col(name)), F.lit(1.0)).cast("double")


def poured(nodes: DataFrame, parent: tuple[str, ...], name: str, weights: dict[str, float]) -> DataFrame:
    """``nodes`` with ``given``: their parent's ``budget`` shared by weight, none above its ``room``."""
    of = [F.col(c) for c in parent] or [F.lit(0)]
    siblings = nodes.withColumn("weight", weight_of(weights, name)).where("weight > 0")
    siblings = siblings.withColumn("ratio", F.col("room") / F.col("weight"))
    order = W.partitionBy(*of).orderBy("ratio", name)
    before = F.coalesce(F.sum("room").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    ahead = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    siblings = siblings.withColumn("full", F.col("ratio") * ahead <= F.col("budget") - before)
    everyone = W.partitionBy(*of)
    taken = F.sum(F.when(F.col("full"), F.col("room")).otherwise(0.0)).over(everyone)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(everyone)
    siblings = siblings.withColumns({"taken": taken, "open_weight": open_weight})
    given = F.when(F.col("full"), F.col("room")).otherwise((F.col("budget") - F.col("taken")) / F.col("open_weight") * F.col("weight"))
    return siblings.withColumn("given", given)


def budgets(leaves: DataFrame, weights: tuple[dict[str, float], ...], budget: float | None, budget_share: float, max_epochs: int) -> DataFrame:
    """``l1, l2, l3, tokens, given``: the tokens each leaf is to give, from the tokens it has."""
    room = (F.sum("tokens") * max_epochs).cast("double").alias("room")
    total = leaves.agg(
        F.least(F.lit(budget) if budget is not None else F.sum("tokens") * budget_share, F.sum("tokens") * max_epochs).cast("double").alias("budget")
    )
    below = total
    for depth, name in enumerate(LEVELS):
        parent, path = LEVELS[:depth], LEVELS[: depth + 1]
        nodes = leaves.groupBy(*path).agg(room)
        nodes = nodes.join(below, list(parent)) if parent else nodes.withColumn("one", F.lit(1)).join(F.broadcast(below.withColumn("one", F.lit(1))), "one").drop("one")
        # Weights of 0 may leave less room than the budget.
        nodes = nodes.withColumn("budget", F.least("budget", F.sum("room").over(W.partitionBy(*[F.col(c) for c in parent] or [F.lit(0)]))))
        below = poured(nodes, parent, name, weights[depth]).select(*path, F.col("given").alias("budget"))
    return leaves.join(below.withColumnRenamed("budget", "given"), list(LEVELS))


def choose(
    docs: DataFrame,
    levels: tuple[Column, Column, Column],
    weights: tuple[dict[str, float], dict[str, float], dict[str, float]],
    budget: float | None = None,
    budget_share: float = 0.5,
    max_epochs: int = 2,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, text_key, l1, l2, l3, tokens, epochs``: how often each chosen document is taken.

    ``budget`` is in words; without it, ``budget_share`` of all words is taken.
    """
    body = F.col("_text")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), whole(text).alias("_text"), *[F.coalesce(level.cast("string"), F.lit("")).alias(name) for level, name in zip(levels, LEVELS)]
    )
    rows = rows.select("doc_id", text_key(body).alias("text_key"), *LEVELS, F.size(words_of(body)).cast("bigint").alias("tokens"))
    rows = rows.groupBy("doc_id", "text_key").agg(*[F.min(c).alias(c) for c in LEVELS], F.max("tokens").alias("tokens"))
    leaf = F.concat_ws("\x1f", *LEVELS)
    rows, _ = kept_at(rows.withColumn("leaf", leaf), "counted")

    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    given = budgets(leaves, weights, budget, budget_share, max_epochs)
    # Whole numbers, so that the last digits of sums decide nothing.
    words = F.floor(F.col("given") + 1e-6).cast("bigint")
    passes = F.when(F.col("tokens") > 0, F.floor(words / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(0).cast("bigint")
    plan = given.select(leaf.alias("leaf"), passes.alias("passes"), (words - passes * F.col("tokens")).alias("rest"))
    plan = stored(plan, "plan")

    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # Every document of a leaf goes by its pass: the large side stays where it is if the plan is small.
    placed = attach(rows, plan, "leaf", "text_key").withColumn("place", place)
    placed = placed.withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    sums = placed.groupBy("leaf", "slice").agg(F.sum("tokens").alias("own"), F.max("rest").alias("rest"))
    running = F.sum("own").over(W.partitionBy("leaf").orderBy("slice"))
    sums = sums.withColumn("upto", running)
    # The slice in which the rest ends, and the total before it.
    cut = sums.where("upto > rest").groupBy("leaf").agg(F.min(F.struct("slice", (F.col("upto") - F.col("own")).alias("before"))).alias("cut"))
    ends = plan.join(cut, "leaf", "left").select("leaf", F.coalesce("cut.slice", F.lit("g")).alias("end"), F.coalesce("cut.before", F.lit(0)).alias("before"))
    placed = attach(placed, stored(ends, "ends"), "leaf", "text_key")
    columns = ["doc_id", "text_key", *LEVELS, "tokens"]
    upto_end = placed.where(F.col("slice") != F.col("end")).select(*columns, (F.col("passes") + F.when(F.col("slice") < F.col("end"), 1).otherwise(0)).alias("epochs"))
    last = placed.where(F.col("slice") == F.col("end"))
    total = F.col("before") + F.sum("tokens").over(W.partitionBy("leaf").orderBy("place", "text_key").rowsBetween(W.unboundedPreceding, 0))
    in_end = last.withColumn("total", total).select(*columns, (F.col("passes") + F.when(F.col("total") <= F.col("rest"), 1).otherwise(0)).alias("epochs"))
    return upto_end.unionByName(in_end).where("epochs > 0")


def mix(docs: DataFrame, *args, doc_id: str = "doc_id", text: str = "text", epoch: str | None = None, **options) -> DataFrame:
    """The chosen documents with all their columns, once per pass; ``epoch`` names a column for the pass, from 0."""
    chosen = choose(docs, *args, doc_id=doc_id, text=text, **options)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int") - 1)).alias("_epoch"))
    keyed = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), text_key(whole(text)).alias("own")).dropDuplicates(["id", "own"])
    joined = keyed.join(chosen, keyed["id"].eqNullSafe(chosen["_id"]) & (keyed["own"] == chosen["_key"]))
    return joined.select("doc.*", *([F.col("_epoch").alias(epoch)] if epoch else []))
