"""Mixing sources to target weights by hierarchical budgeting.

Documents form a tree: domain, language, source.  A leaf can give its tokens
``epochs`` times.  A node's budget is dealt to its children in proportion to
their weights; a child that has less than its share gives all it has, and the
shortage goes to its siblings, so that it reaches the ancestors' other
children only when the whole family is short.  This is water-filling from the
root down, with a node's capacity the sum of its leaves': the children that
are short are those first in the order of capacity to weight, and integer
windows over siblings give them at once.

A leaf with budget b and t tokens is taken b // t times whole; the rest of
its budget is the longest prefix, in the seeded order of the next epoch, that
fits.  Prefix sums are kept per leaf and hash bucket (at most 65,536 a leaf),
and rows are ordered only inside the one bucket where the prefix ends, so a
leaf with a third of all rows is not gathered in a task; its rows meet its
figures in ``SALTS`` shares.

Tokens are words ``[^\\x20\\x09-\\x0D]+``.  Rows: a null text is empty, null
sources and languages are nodes of their own, rows that share an id in a leaf
are taken or left together.  A weight that is null or not positive gives
nothing.  A budget above all capacities takes everything ``epochs`` times.  An
empty table gives an empty result.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

TREE = ["domain", "lang", "source"]
#: Shares into which the rows of a leaf are dealt when they meet the leaf's figures.
SALTS = 64


def domain_of(source: str = "source") -> Column:
    """A domain for sources that name none: one of four by the source's md5."""
    digit = F.substring(F.md5(F.coalesce(F.col(source), F.lit(""))), 1, 1)
    return F.when(digit < "4", "d0").when(digit < "8", "d1").when(digit < "c", "d2").otherwise("d3")


def tokens_of(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _deal(nodes: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Budgets of the children of each parent: ``nodes`` has ``budget`` (of the parent), ``weight`` and ``cap``.

    In the order of cap / weight a child is short when its cap is at most
    its share of what is left of the budget after those before it.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    up = by.orderBy((F.col("cap").cast("double") / F.col("weight").cast("double")).asc(), F.col(node).asc())
    upto = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("cap", "weight", "budget")}  # products of two counts
    n = (nodes.where("weight > 0").withColumns(exact)
         .withColumn("w0", F.sum("weight").over(upto) - F.col("weight")).withColumn("c0", F.sum("cap").over(upto) - F.col("cap"))
         .withColumn("w", F.sum("weight").over(by))
         .withColumn("short", F.col("cap") * (F.col("w") - F.col("w0")) <= (F.col("budget") - F.col("c0")) * F.col("weight")))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("short"), F.col("cap"))).over(by), F.lit(0))
    open_w = F.when(F.col("short"), 0).otherwise(F.col("weight"))
    n = (n.withColumn("left", left).withColumn("ow", F.sum(open_w).over(by)).withColumn("o1", F.sum(open_w).over(upto))
         .withColumn("given", F.when(F.col("short"), F.col("cap")).otherwise(F.least(
             F.col("cap"), F.expr("left * o1 div ow - left * (o1 - weight) div ow")))))
    return n.select(*parents, node, F.col("given").cast("long").alias("budget"))


def leaf_budgets(leaves: DataFrame, budget: int, epochs: int, weights: DataFrame | None = None) -> DataFrame:
    """``(domain, lang, source, tokens, budget)`` of each leaf; ``leaves`` has ``tokens``.

    ``weights`` has ``level`` (domain, lang or source), the node's columns
    (null above its level's own) and ``weight`` (whole number); without it a
    node weighs the whole square root of its tokens.
    """
    found = leaves.withColumn("cap", F.col("tokens") * F.lit(epochs))
    held = None
    for depth, node in enumerate(TREE):
        parents = TREE[:depth]
        nodes = found.groupBy(*parents, node).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        if weights is None:
            nodes = nodes.withColumn("weight", F.floor(F.sqrt(F.col("tokens").cast("double"))).cast("long"))
        else:
            w = weights.where(F.col("level") == node).groupBy(*parents, node).agg(F.max("weight").cast("long").alias("weight"))
            nodes = nodes.join(w, [*parents, node], "left")
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if held is None else nodes.join(held, parents)
        held = _deal(nodes, parents, node)
    return leaves.join(held, TREE, "left").select(*TREE, "tokens", F.coalesce("budget", F.lit(0)).alias("budget"))


def copies(docs: DataFrame, share: tuple[int, int] = (9, 10), epochs: int = 2, seed: int = 7,
           weights: DataFrame | None = None, domain: Column | None = None) -> DataFrame:
    """``(doc_id, domain, lang, source, n_tokens, copies)``, one row per input row.

    The budget is ``share[0] / share[1]`` of all tokens, rounded down.
    """
    with C.tables() as t:
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(domain if domain is not None else domain_of(), F.lit("")).alias("domain"),
            F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
            tokens_of().alias("n_tokens"))
        salt = F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int")
        rows = t.table(rows.withColumn("salt", salt))
        on = [*TREE, "salt"]
        salted = lambda leaf: leaf.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        leaves = rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"))
        total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        leaves = leaf_budgets(leaves, total * share[0] // share[1], epochs, weights)
        leaves = t.table(leaves.where("tokens > 0").withColumn("whole", F.expr("budget div tokens")).withColumn(
            "rest", F.col("budget") % F.col("tokens")))
        order = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        # a leaf without tokens has no row in ``leaves``: its documents cost nothing and are left out
        placed = rows.join(salted(leaves), on, "left").withColumn("h", order).withColumn(
            "bucket", F.conv(F.substring("h", 1, 4), 16, 10).cast("int"))
        sums = placed.where("rest is not null").groupBy(*TREE, "bucket").agg(F.sum("n_tokens").alias("s"), F.first("rest").alias("rest"))
        run = Window.partitionBy(*TREE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = (sums.withColumn("upto", F.sum("s").over(run)).where("upto > rest").groupBy(*TREE)
                .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("s")).alias("before"))).alias("e"))
                .select(*TREE, F.col("e.bucket").alias("end"), F.col("e.before").alias("before")))
        placed = placed.join(salted(ends), on, "left")
        inside = F.col("bucket") == F.col("end")
        within = Window.partitionBy(*TREE).orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        out = [*TREE, "doc_id", "n_tokens", "whole"]
        edge = placed.where(inside).withColumn("taken", (F.col("rest") > 0) & (F.col("before") + F.sum("n_tokens").over(within) <= F.col("rest")))
        away = placed.where(~F.coalesce(inside, F.lit(False))).withColumn("taken", F.coalesce(F.col("rest") > 0, F.lit(False)) & F.coalesce(F.col("bucket") < F.col("end"), F.lit(True)))
        done = edge.select(*out, "taken").unionByName(away.select(*out, "taken"))
        return C.staged(done.select("doc_id", *TREE, "n_tokens", F.coalesce(
            F.col("whole") + F.col("taken").cast("long"), F.lit(0)).cast("int").alias("copies")))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as it is taken."""
    taken = copies(docs, **how).where("copies > 0").groupBy("doc_id", "lang", "source").agg(F.max("copies").alias("_copies"))
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("source").alias("_source"), "_copies")
    hit = (F.col("_id").eqNullSafe(F.col("doc_id").cast("long")) & (F.col("_lang") == F.coalesce("lang", F.lit("")))
           & (F.col("_source") == F.coalesce("source", F.lit(""))))
    return (docs.join(taken, hit).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
