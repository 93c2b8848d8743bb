"""Mix sources to target weights under a token budget, with DataFrame operations only.

The columns `levels` name each document's path in a tree (say domain, language,
source).  A node's capacity is the tokens below it times `max_epochs`.  From
the root down each parent shares its budget among its children by weight; a
child that lacks the tokens for its share gives the rest back to its siblings,
again by weight, and only what all siblings together lack goes back to the
parent's own siblings: a node never gets more than its capacity.

A leaf with budget b and t tokens yields b div t whole epochs and then a prefix
of the next one: documents in the order of a hash of (seed, epoch, id), while
their tokens fit into what is left.  The prefix is found by counts: tokens by
the first HEX hex digits of the hash, then exactly in the one bucket where the
budget ends, so that no leaf is ever sorted as a whole.  The result is a bound
of the hash for each leaf, which the documents are compared with where they lie.

Defined results: null names the node "(null)"; null text has no tokens;
documents that share an id and leaf are taken together; weights are whole
numbers, a null or non-positive one gives no budget; whole-token rounding may
leave up to one token for each child; an empty table gives an empty frame.
Columns other than `doc_id`, `text` and the levels are passed through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stash

#: Hex digits of the hash that the first count of a leaf distinguishes (4096 buckets).
HEX = 3


def tokens(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def epoch_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch, as text: a hash, then the id."""
    own = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), own)), F.lit("."), own)


def budgets(leaves: DataFrame, levels: list[str], weights: list[Column], budget: Column, max_epochs: int) -> DataFrame:
    """`leaves` (one row for each leaf: the levels, leaf_tokens) with `leaf_budget`."""
    wide = "decimal(38,0)"
    nodes = leaves.withColumn("cap", (F.col("leaf_tokens") * max_epochs).cast(wide))
    parent = nodes.agg(F.coalesce(F.sum("cap"), F.lit(0)).cast(wide).alias("cap"), F.sum("leaf_tokens").alias("all_tokens"))
    parent = parent.select(F.least(F.col("cap"), F.floor(budget).cast(wide)).alias("b"), F.lit(1).alias("_root"))
    for i, weight in enumerate(weights):
        up, own = levels[:i], levels[:i + 1]
        child = nodes.groupBy(*own).agg(F.sum("cap").cast(wide).alias("cap"))
        w = F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)).cast("decimal(18,0)")
        child = child.withColumn("w", w).withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(F.lit(0)))
        child = child.withColumn("_root", F.lit(1)).join(parent, ["_root", *up])
        # fill the children that run out first; those before the first that doesn't are full
        full_first = Window.partitionBy("_root", *up).orderBy(
            (F.col("w") <= 0).cast("int"), F.col("cap").cast("double") / F.when(F.col("w") > 0, F.col("w")).cast("double"), *own)
        upto = full_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = full_first.rowsBetween(1, Window.unboundedFollowing)
        whole = Window.partitionBy("_root", *up)
        child = child.withColumns({"c": F.sum("cap").over(upto), "rest": F.coalesce(F.sum("w").over(after), F.lit(0))})
        child = child.withColumn("full", (F.col("w") <= 0) | (
            F.col("c").cast("decimal(20,0)") * F.col("w") + F.col("cap").cast("decimal(20,0)") * F.col("rest").cast("decimal(18,0)")
            <= F.col("b").cast("decimal(20,0)") * F.col("w")))
        child = child.withColumns({
            "left": (F.col("b") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(F.lit(0))).over(whole)).cast("decimal(20,0)"),
            "share": F.sum(F.when(~F.col("full"), F.col("w")).otherwise(F.lit(0))).over(whole).cast("decimal(18,0)")})
        share = F.expr("CAST((left * w) div nullif(share, 0) AS decimal(38,0))")
        parent = child.select("_root", *own, F.when(F.col("full"), F.col("cap")).otherwise(share).cast(wide).alias("b"))
    out = parent.select(*levels, F.col("b").cast("long").alias("leaf_budget"))
    return leaves.join(out, levels)


def plan(docs: DataFrame, levels: list[str], weights: list[Column], share: float, max_epochs: int, seed: int):
    """(documents' ids, nodes and tokens, written once; one row for each leaf:
    epochs to take whole, number of the last epoch, bounds of its prefix)."""
    named = docs.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in levels})
    rows = stash(named.select("doc_id", *levels, tokens(F.col("text")).alias("tokens")), "mix-tokens")
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("leaf_tokens"))
    leaf = budgets(leaves, levels, weights, F.col("all_tokens") * F.lit(share), max_epochs)
    leaf = leaf.where("leaf_tokens > 0 AND leaf_budget > 0")
    leaf = leaf.withColumn("epochs", F.expr("leaf_budget div leaf_tokens"))
    leaf = stash(leaf.withColumn("room", F.col("leaf_budget") - F.col("epochs") * F.col("leaf_tokens")), "mix-leaves")
    keyed = rows.join(leaf, levels).withColumn("key", epoch_key(seed, F.col("epochs"), F.col("doc_id")))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, HEX))
    sums = keyed.groupBy(*levels, "room", "bucket").agg(F.sum("tokens").alias("n"))
    along = Window.partitionBy(*levels).orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("n").over(along))
    edge = (sums.where("upto > room").groupBy(*levels)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("edge"))
            .select(*levels, F.col("edge.bucket").alias("edge"), F.col("edge.before").alias("before")))
    inside = keyed.join(edge, levels).where(F.col("bucket") == F.col("edge"))
    upto = Window.partitionBy(*levels).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (inside.withColumn("upto", F.col("before") + F.sum("tokens").over(upto)).where("upto <= room")
            .groupBy(*levels).agg(F.max("key").alias("last")))
    # all keys below the edge's digits, and those up to `last` that begin with them
    leaf = leaf.join(edge.drop("before"), levels, "left").join(last, levels, "left")
    bound = F.coalesce("last", "edge", F.lit("g"))
    return rows, stash(leaf.select(*levels, "epochs", bound.alias("bound")), "mix-bounds")


def copies(seed: int, epochs: Column, bound: Column) -> Column:
    """How often a document is taken, by its leaf's epochs and bound."""
    return epochs + (epoch_key(seed, epochs, F.col("doc_id")) <= bound).cast("long")


def select(docs: DataFrame, levels: list[str], weights: list[Column], share: float = 0.5, max_epochs: int = 3,
           seed: int = 7) -> DataFrame:
    """doc_id, the levels, tokens and copies (at least 1) of the chosen documents."""
    rows, leaf = plan(docs, levels, weights, share, max_epochs, seed)
    found = rows.join(leaf, levels).withColumn("copies", copies(seed, F.col("epochs"), F.col("bound"))).where("copies > 0")
    return found.select("doc_id", *levels, "tokens", "copies")


def mixed(docs: DataFrame, levels: dict[str, Column], weights: list[Column], share: float = 0.5, max_epochs: int = 3,
          seed: int = 7) -> DataFrame:
    """The chosen documents with all their columns, each as often as it is
    taken.  The texts are only read, never shuffled."""
    names = [f"_{k}" for k in levels]
    # the row stands aside as one column, so that no name of its own can clash
    own = docs.select(F.struct("*").alias("row"), "doc_id", "text",
                      *[F.coalesce(c.cast("string"), F.lit("(null)")).alias(f"_{k}") for k, c in levels.items()])
    _, leaf = plan(own, names, weights, share, max_epochs, seed)
    found = own.join(leaf, names).withColumn("copies", copies(seed, F.col("epochs"), F.col("bound"))).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def weight_of(column: str, table: dict[str, int], other: int = 1) -> Column:
    """A weight for each value of a column."""
    return reduce(lambda c, kv: c.when(F.col(column) == kv[0], kv[1]), table.items(), F.when(F.lit(False), 0)).otherwise(other)
