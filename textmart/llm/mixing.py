"""Mixing sources to target weights by budgets in a tree (domain, language, source, or any other levels).

A node's budget is shared among its children by weight, but none gets more than its
leaves can give (their tokens times `max_epochs`). What a child can't take goes to its
siblings by weight; only what no sibling can take stays with the parent, which for that
reason was given no more than its children can take together: shortages move to
siblings first and then to the parent's siblings. `least_epochs` whole epochs of every
leaf can be taken beforehand; the weights then share out what the budget leaves.

A leaf's texts are put in a seeded order for each epoch. A leaf takes whole epochs as
its budget allows, and of the next one the texts from the start whose tokens reach the
rest; the last of them counts in part.

Shares are found by rounds of aggregates over the nodes of a level (those full are set
aside, the rest is shared again), and the place where an epoch ends from sums over at
most BUCKETS ranges of the order and then within one of them, so no task sees all texts
of a leaf.

Defined cases: a null level value is a node of its own. A text without tokens is in no
epoch. A weight of null or below 0 counts as 0, a node without a row in the weights gets
`default_weight`; nodes of weight 0 get nothing. Rows of one leaf with the same key and
text have one place in the order and are taken together. A budget beyond what all can
give takes `max_epochs` of everything. An empty table gives no rows. Columns with the
names of the result are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmart.llm.common import written

BUCKETS = 1024
RESULT = ("n_tokens", "epochs", "take_tokens")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def paths(levels: Sequence[str]) -> list[Column]:
    """The node of each level as one string: the values from the root down to it."""
    marked = [F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(c).cast("string"))) for c in levels]
    return [F.concat_ws("\x1f", *marked[: i + 1]) for i in range(len(marked))]


def filled(children: DataFrame, budgets: DataFrame) -> DataFrame:
    """(node, budget): each parent's budget shared among (node, parent, weight, capacity).

    `budgets`: (parent, budget), a budget no larger than the children's capacities together.
    """
    state = children.join(budgets, "parent").select("*", F.lit(False).alias("full"))
    while True:
        left = state.groupBy("parent").agg(
            (F.first("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0.0))).alias("rest"),
            F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).alias("weights"),
        )
        level = F.when(F.col("weights") > 0, F.greatest("rest", F.lit(0.0)) / F.col("weights")).otherwise(0.0)
        shared = state.join(left.select("parent", level.alias("level")), "parent").withColumn("share", F.col("level") * F.col("weight"))
        now_full = F.col("full") | (F.col("share") >= F.col("capacity"))
        shared = written(shared.withColumn("newly", now_full & ~F.col("full")).withColumn("full", now_full), "shares")
        if not shared.where("newly").limit(1).count():
            return shared.select("node", F.when(F.col("full"), F.col("capacity")).otherwise(F.col("share")).alias("budget"))
        state = shared.drop("level", "share", "newly")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: dict[str, DataFrame], budget: float, max_epochs: int, power: float = 0.5, least_epochs: int = 0, default_weight: float = 1.0) -> DataFrame:
    """(node, tokens, budget) of each leaf. `leaves`: the level columns and tokens."""
    free = float(budget)
    if least_epochs:
        free -= least_epochs * float(leaves.agg(F.sum("tokens")).first()[0] or 0)
    names = [f"_p{i}" for i in range(len(levels))]
    tree = leaves.select(*levels, "tokens", *[p.alias(n) for p, n in zip(paths(levels), names)])
    nodes = []
    for i, level in enumerate(levels):
        # A node's weight is that of its row in the level's table, else a power of its tokens.
        here = tree.groupBy(F.col(names[i]).alias("node")).agg(
            F.first(names[i - 1]).alias("parent") if i else F.lit("").alias("parent"), F.sum("tokens").alias("tokens"), F.first(level).alias("value")
        )
        if level in weights:
            table = weights[level].select(F.col(level).alias("_value"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).cast("double").alias("_weight"))
            table = table.groupBy("_value").agg(F.max("_weight").alias("_weight"))
            here = here.join(table, here["value"].eqNullSafe(table["_value"]), "left").withColumn("weight", F.coalesce("_weight", F.lit(default_weight)))
        else:
            here = here.withColumn("weight", F.pow(F.col("tokens").cast("double"), F.lit(power)))
        nodes.append(written(here.select("node", "parent", "tokens", "weight"), "nodes"))
    # What a node can take: its leaves' tokens in all epochs, but for those without weight.
    able = nodes[-1].select("node", "parent", "weight", F.when(F.col("weight") > 0, F.col("tokens") * float(max_epochs - least_epochs)).otherwise(0.0).alias("capacity"))
    capable = [able]
    for level_nodes in reversed(nodes[:-1]):
        below = capable[0].groupBy(F.col("parent").alias("node")).agg(F.sum("capacity").alias("below"))
        here = level_nodes.join(below, "node").select("node", "parent", "weight", F.when(F.col("weight") > 0, F.col("below")).otherwise(0.0).alias("capacity"))
        capable.insert(0, written(here, "capacities"))
    given = capable[0].groupBy("parent").agg(F.least(F.sum("capacity"), F.lit(max(free, 0.0))).alias("budget"))
    for here in capable:
        given = filled(here, given).withColumnRenamed("node", "parent")
    leaf = given.withColumnRenamed("parent", "node")
    return nodes[-1].select("node", "tokens").join(leaf, "node").select("node", "tokens", (F.floor(F.col("budget") + 1e-6).cast("long") + least_epochs * F.col("tokens")).alias("budget"))


def order_of(seed: int, epoch: Column, key: Column, text_hash: Column) -> Column:
    """A row's place in an epoch's order."""
    return F.xxhash64(F.lit(seed), epoch, key, text_hash)


def mix(docs: DataFrame, budget: float | None, levels: Sequence[str] = ("domain", "lang", "source"), weights: dict[str, DataFrame] | None = None, key: str = "doc_id", text: str = "text", max_epochs: int = 4, power: float = 0.5, least_epochs: int = 0, seed: int = 1, tokens: Column | None = None, share: float = 1.0) -> DataFrame:
    """The rows taken at least in part, with n_tokens, `epochs` (how often a row is taken, a part
    counting as once) and `take_tokens` (tokens taken in all epochs).

    `budget` is in tokens; None stands for `share` times all tokens.
    """
    levels = list(levels)
    count = tokens if tokens is not None else word_count(F.col(text))
    leaf_path = paths(levels)[-1]
    narrow = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), leaf_path.alias("node"), *levels, count.alias("tokens"))
    narrow = written(narrow.where("tokens > 0"), "tokens")
    leaves = written(narrow.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    if budget is None:
        budget = share * float(leaves.agg(F.sum("tokens")).first()[0] or 0)
    shares = leaf_budgets(leaves, levels, weights or {}, budget, max_epochs, power, least_epochs).where("budget > 0")
    whole = F.floor(F.col("budget") / F.col("tokens")).cast("int")
    shares = written(shares.select("node", whole.alias("whole"), (F.col("budget") - whole * F.col("tokens")).alias("rest")), "budgets")

    # Where the unfinished epoch ends: sums over ranges of its order, then within one range.
    placed = narrow.join(shares.where("rest > 0"), "node").withColumn("place", order_of(seed, F.col("whole"), F.col("_key"), F.col("_hash")))
    placed = placed.withColumn("bucket", F.shiftright("place", 54).cast("int"))  # 1024 ranges
    sums = placed.groupBy("node", "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy("node").orderBy("bucket"))  # at most BUCKETS rows
    ends = sums.withColumn("upto", running).where("upto >= rest and upto - tokens < rest")
    ends = written(ends.select("node", "bucket", (F.col("upto") - F.col("tokens")).alias("before")), "ends")
    inside = placed.join(ends, ["node", "bucket"]).groupBy("node", "place").agg(F.sum("tokens").alias("tokens"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    upto = F.col("before") + F.sum("tokens").over(Window.partitionBy("node").orderBy("place"))
    cuts = inside.withColumn("upto", upto).where("upto >= rest and upto - tokens < rest")
    cuts = cuts.select("node", F.col("place").alias("cut"), (F.col("rest") - F.col("upto") + F.col("tokens")).alias("part"))
    final = written(shares.join(cuts, "node", "left"), "cuts")

    # Names of its own for what is added: no column of the table has them.
    own = {c: f"{c}_{uuid.uuid4().hex}" for c in (*final.columns, "hash", "path", "taken")}
    final = final.select(*[F.col(c).alias(own[c]) for c in final.columns])
    named = {c: F.col(n) for c, n in own.items()}
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in RESULT]
    wide = docs.select(*rest, leaf_path.alias(own["path"]), count.alias("n_tokens"), F.xxhash64(text).alias(own["hash"]))
    met = wide.join(final, named["path"] == named["node"]).where("n_tokens > 0")
    place = order_of(seed, named["whole"], F.col(key), named["hash"])
    partly = F.when(place < named["cut"], F.col("n_tokens")).when(place == named["cut"], F.least(named["part"], "n_tokens")).otherwise(F.lit(0))
    out = met.withColumn(own["taken"], F.coalesce(partly, F.lit(0)).cast("long"))
    out = out.withColumn("epochs", (named["whole"] + (named["taken"] > 0).cast("int")).cast("int")).withColumn("take_tokens", named["whole"] * F.col("n_tokens") + named["taken"])
    return out.where("epochs > 0").select(*rest, *RESULT)
