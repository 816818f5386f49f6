"""Token budgets down a tree of weighted nodes, and the documents that fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarlake.llm.batches import quoted
from bazaarlake.session import write_and_read

TOKEN = r"[^\x20\x09-\x0D]+"
# Hex digits of a document's order key that name its bucket: 4096 buckets a leaf, so
# the one bucket that is ordered in a single task holds 1/4096 of a leaf.
BUCKET_DIGITS = 3
_WIDE = "decimal(38,0)"


def _node(name: str) -> Column:
    """A level's value as text that keeps null apart from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(name)).cast("string")), F.lit("-"))


def node_budgets(leaves: DataFrame, depth: int, weights: DataFrame, fraction: float,
                 max_epochs: int, default_weight: int = 1) -> DataFrame:
    """(path, available, budget) per leaf; ``leaves`` has path (array of nodes) and available.

    A node can take ``max_epochs`` times the tokens below it, a node of weight 0
    none. From the root down, children share their parent's budget by weight. A child
    whose capacity is smaller than its share is filled, and the rest is shared among
    its siblings; as no node gets more than fits below it, a shortage reaches an
    ancestor's siblings only when all of its own are full. Shares are whole tokens,
    odd ones going to the largest remainders (ties to the first path). Only one row
    per node is handled here.
    """
    given = weights.select(F.transform("path", lambda v: F.coalesce(
        F.concat(F.lit("="), v), F.lit("-"))).alias("path"), F.col("weight").cast("long"))
    nodes = {depth: leaves.select("path", (F.col("available") * max_epochs).alias("cap"))}
    for level in range(depth, 0, -1):
        nodes[level] = nodes[level].join(given, "path", "left").select(
            "path", F.coalesce("weight", F.lit(default_weight)).alias("w"), "cap").selectExpr(
            "path", "w", f"CAST(IF(w > 0, cap, 0) AS {_WIDE}) AS cap")
        if level > 1:
            nodes[level - 1] = nodes[level].groupBy(
                F.slice("path", 1, level - 1).alias("path")).agg(F.sum("cap").alias("cap"))
    total = leaves.agg(F.sum("available").alias("tokens")).selectExpr(
        f"CAST(floor(coalesce(tokens, 0) * {float(fraction)!r}D) AS {_WIDE}) AS wish")
    room = nodes[1].agg(F.sum("cap").alias("room"))
    budgets = total.crossJoin(room).selectExpr(  # one row each
        "CAST(array() AS array<string>) AS path",
        f"CAST(least(wish, coalesce(room, 0)) AS {_WIDE}) AS budget")
    for level in range(1, depth + 1):
        budgets = _share(nodes[level], budgets.withColumnsRenamed(
            {"path": "parent", "budget": "given"}), level)
    return leaves.join(budgets, "path").select("path", "available", F.col("budget").cast("long"))


def _share(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    rows = nodes.filter("w > 0").withColumn("parent", F.slice("path", 1, level - 1)).join(
        parents, "parent")
    rising = Window.partitionBy("parent").orderBy(
        F.col("cap").cast("double") / F.col("w"), "path")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    siblings = Window.partitionBy("parent")
    rows = rows.withColumns({
        "taken": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "open": F.sum("w").over(after)})
    rows = rows.withColumn("full", F.expr(
        f"cap * CAST(open AS decimal(20,0)) <= CAST(given - taken AS {_WIDE}) * w"))
    rows = rows.withColumns({
        "rest": F.expr("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(
            siblings), F.lit(0)),
        "all_w": F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings)})
    rows = rows.withColumns({
        "part": F.expr(f"CAST(CAST(rest AS {_WIDE}) * w div all_w AS {_WIDE})"),
        "odd": F.expr(f"CAST(rest AS {_WIDE}) * w % all_w")})
    rows = rows.withColumn("spare", F.col("rest") - F.sum(
        F.when(~F.col("full"), F.col("part"))).over(siblings))
    first = Window.partitionBy("parent", "full").orderBy(F.desc("odd"), "path")
    return rows.select("path", F.when(F.col("full"), F.col("cap")).otherwise(
        F.col("part") + (F.row_number().over(first) <= F.col("spare")).cast("int")).cast(
        _WIDE).alias("budget"))


def mix_documents(
    docs: DataFrame, key: str, text: str, levels: list[str | Column], weights: DataFrame,
    fraction: float, max_epochs: int = 1, seed: int = 0, default_weight: int = 1,
) -> DataFrame:
    """Documents of a mix: key, epoch (from 0), tokens, tokens_taken (over 0).

    ``levels`` are the tree's levels from the top; ``weights`` has path (array of
    values from the top) and weight (whole number). The mix has ``fraction`` of all tokens
    (words), or what ``max_epochs`` readings allow. A leaf's budget is read off its
    documents in a seeded order, new for each epoch; the last document is cut
    where the budget ends (``tokens_taken`` < ``tokens``). Documents without words are
    never taken. Null levels are nodes of their own; repeated rows are documents of
    their own; a null key is a key like others; an empty frame gives an empty mix.

    Counts meet map-side; a leaf that holds a third of all rows is ordered in 4096
    hashed buckets of which only the one where the budget ends is sorted.
    """
    columns = [level if isinstance(level, Column) else F.col(quoted(level)) for level in levels]
    named = docs.select(
        F.col(quoted(key)).alias("key"),
        *[c.cast("string").alias(f"level_{i}") for i, c in enumerate(columns)],
        F.regexp_count(F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")),
                       F.lit(TOKEN)).cast("long").alias("tokens"))
    narrow = write_and_read(named.select("key", "tokens", F.array(
        *[_node(f"level_{i}") for i in range(len(columns))]).alias("path")).filter(
        "tokens > 0"), "mix")
    # Written, as later steps name them many times: one row per leaf each.
    leaves = write_and_read(narrow.groupBy("path").agg(F.sum("tokens").alias("available")), "mix")
    budgets = node_budgets(leaves, len(columns), weights, fraction, max_epochs, default_weight)
    plan = write_and_read(budgets.filter("budget > 0").selectExpr(
        "path AS leaf", "budget div available AS full", "budget % available AS rest"), "mix")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("full").cast("string"),
                              F.coalesce(F.col("key").cast("string"), F.lit(""))))
    placed = narrow.join(plan, F.col("path") == F.col("leaf")).withColumn(
        "place", order).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = placed.filter("rest > 0").groupBy("leaf", "bucket", "rest").agg(
        F.sum("tokens").alias("size"))
    upto = Window.partitionBy("leaf").orderBy("bucket")
    last = write_and_read(sums.withColumn(
        "before", F.sum("size").over(upto) - F.col("size")).filter(
        "before < rest AND before + size >= rest").select(
        F.col("leaf").alias("cut_leaf"), F.col("bucket").alias("cut"), "before"), "mix")
    marked = placed.join(last, F.col("leaf") == F.col("cut_leaf"), "left")
    full = marked.filter("full > 0").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1)).alias("epoch"),
        "tokens", F.col("tokens").alias("tokens_taken"))
    partly = marked.filter("bucket < cut").selectExpr(
        "key", "CAST(full AS int) AS epoch", "tokens", "tokens AS tokens_taken")
    inside = Window.partitionBy("leaf").orderBy("place", "key", "tokens").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = marked.filter("bucket = cut").withColumn("open", F.col("rest") - F.col(
        "before") - F.coalesce(F.sum("tokens").over(inside), F.lit(0))).filter(
        "open > 0").selectExpr("key", "CAST(full AS int) AS epoch", "tokens",
                               "least(tokens, open) AS tokens_taken")
    return full.unionByName(partly).unionByName(cut)
