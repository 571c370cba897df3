"""Mixing of sources to target weights: token budgets down a tree, then a token prefix of seeded epochs per leaf.

The tree's levels are columns, domain, language and source for instance. A node can give at most the tokens of its leaves
times ``max_epochs``. From the root down, each node's budget goes to its children in proportion to their weights; what a
child cannot give goes to its siblings, again by weight, and only what all siblings together cannot give had already
gone to the siblings of an ancestor, because a node never gets more than its subtree can give. Budgets are whole
tokens: the rest of the division goes to the largest remainders.

A leaf repeats its documents in epochs, each in an order of its own (md5 of seed, epoch and id), and takes the documents
before its budget is used up; the last one counts with the tokens that still fit. Orders are cut into slices by
the first digits of the hash, so a leaf with a third of all rows is summed and ordered in thousands of parts.

Everything is DataFrame functions. Rules: NULL in a level is the level value ""; documents without tokens are never taken;
a NULL id counts as the empty text; rows with equal ids are separate documents, ordered by their tokens; nodes
without a weight have weight 1, weight 0 takes nothing; a budget beyond what all leaves can give takes all; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.base import stored

_SLICE_DIGITS = 3     # hexadecimal digits of the hash: 4,096 slices of each leaf and epoch
_SEPARATOR = "\x1f"
_WIDE = "decimal(28,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(levels: list[str], weights: dict[tuple[str, ...], int]) -> Column:
    """Weight of the node that ``levels`` name, 1 unless given."""
    mine = {k: v for k, v in weights.items() if len(k) == len(levels)}
    if not mine:
        return F.lit(1).cast("long")
    table = F.create_map(*(F.lit(x) for path, w in mine.items() for x in (_SEPARATOR.join(path), int(w))))
    return F.coalesce(table[F.concat_ws(_SEPARATOR, *levels)], F.lit(1)).cast("long")


def _share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``given`` to rows of (parent's columns, name, weight, most, budget of the parent).

    Children are taken in the order in which a rising water level (tokens per weight) fills them up: those below the
    final level give all they have, the others their weight's part of what is left.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(1))
    rising = family.orderBy(F.col("most") / F.col("weight"), name)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wide = lambda c: c.cast(_WIDE)
    out = (nodes.withColumn("filled", F.coalesce(F.sum("most").over(before), F.lit(0)))
           .withColumn("open_weight", F.sum("weight").over(onward)))
    full = F.col("most").cast("decimal(19,0)") * F.col("open_weight").cast("decimal(19,0)") <= (
        (F.col("budget") - F.col("filled")).cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)"))
    out = out.withColumn("full", full)
    whole = family.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (out.withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(whole), F.lit(0)))
           .withColumn("sharers", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)))
    product = wide(F.col("left")) * F.col("weight").cast("decimal(10,0)")
    out = (out.withColumn("part", F.when(~F.col("full"), F.floor((product - product % F.col("sharers")) / F.col("sharers")).cast("long")))
           .withColumn("remainder", F.when(~F.col("full"), (product % F.col("sharers")).cast("long"))))
    over = F.col("left") - F.coalesce(F.sum("part").over(whole), F.lit(0))
    place = F.row_number().over(family.orderBy(F.col("full"), F.col("remainder").desc(), name))
    out = out.withColumn("over", over).withColumn("place", place)
    given = F.when(F.col("full"), F.col("most")).otherwise(F.col("part") + (F.col("place") <= F.col("over")).cast("long"))
    return out.withColumn("given", given).drop("filled", "open_weight", "full", "left", "sharers", "part", "remainder", "over", "place")


def leaf_budgets(supply: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int], share: tuple[int, int],
                 max_epochs: int) -> DataFrame:
    """(levels, tokens, budget) of each leaf. ``supply``: (levels, tokens); the root's budget is ``share`` (numerator and
    denominator) of all tokens."""
    leaves = supply.withColumn("most", F.col("tokens") * max_epochs)
    for k in range(len(levels)):  # what lies under a node of weight 0 cannot be given
        leaves = leaves.withColumn(f"weight_{k}", _weight(levels[:k + 1], weights)).where(F.col(f"weight_{k}") > 0)
    leaves = stored(leaves, "leaves")
    wanted = (supply.agg(F.sum("tokens")).first()[0] or 0) * share[0] // share[1]
    budget = min(wanted, leaves.agg(F.sum("most")).first()[0] or 0)
    given = None
    for k, level in enumerate(levels):  # a level is written before the next one asks for it
        path = levels[:k + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("most").alias("most"), F.first(f"weight_{k}").alias("weight"))
        nodes = (nodes.withColumn("budget", F.lit(budget).cast("long")) if given is None
                 else nodes.join(given.withColumnRenamed("given", "budget"), path[:-1]))
        given = stored(_share_out(nodes, path[:-1], level).select(*path, "given"), "budgets")
    return leaves.join(given, levels).select(*levels, "tokens", F.col("given").alias("budget"))


def _order(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _with_levels(docs: DataFrame, levels: dict[str, Column], tokens: Column) -> DataFrame:
    return docs.select("*", *(F.coalesce(c.cast("string"), F.lit("")).alias(f"_{k}") for k, c in levels.items()), tokens.alias("_tokens"))


def _plan(rows: DataFrame, levels: list[str], weights, share, max_epochs) -> DataFrame:
    supply = stored(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "supply")
    plan = (leaf_budgets(supply, levels, weights, share, max_epochs).where("budget > 0")
            .withColumn("whole_epochs", F.expr("budget div tokens")).withColumn("part", F.expr("budget % tokens"))
            .select(*levels, F.col("tokens").alias("leaf_tokens"), "whole_epochs", "part"))
    return stored(plan, "leaf-budgets")  # measured as small, so rows need not move to meet it


def mixture(docs: DataFrame, levels: dict[str, Column], weights: dict[tuple[str, ...], int], share: tuple[int, int],
            max_epochs: int = 4, seed: int = 7, tokens: Column | None = None) -> DataFrame:
    """(doc_id, levels, epoch, start, n_tokens, n_taken): the documents that each leaf's epochs take, with their place."""
    names = list(levels)
    count = word_count(F.col("text")) if tokens is None else tokens
    rows = (_with_levels(docs, levels, count)
            .select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(f"_{k}").alias(k) for k in names), F.col("_tokens").alias("tokens"))
            .where("tokens > 0"))
    rows = stored(rows, "mixing-tokens")  # counted once: the plan and the epochs read it
    plan = _plan(rows, names, weights, share, max_epochs)
    last = F.col("whole_epochs") - F.when(F.col("part") > 0, F.lit(0)).otherwise(F.lit(1))
    spread = (rows.join(plan, names).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .withColumn("key", _order(seed, F.col("epoch"), F.col("doc_id")))
              .withColumn("slice", F.substring("key", 1, _SLICE_DIGITS)))
    slot = [*names, "epoch", "slice"]
    sizes = spread.groupBy(*slot).agg(F.sum("tokens").alias("slice_tokens"))
    before = (F.sum("slice_tokens").over(Window.partitionBy(*names, "epoch").orderBy("slice")) - F.col("slice_tokens"))
    sizes = sizes.select(*slot, before.alias("slice_start"))
    inside = F.sum("tokens").over(Window.partitionBy(*slot).orderBy("key", "doc_id", "tokens")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    limit = F.when(F.col("epoch") < F.col("whole_epochs"), F.col("leaf_tokens")).otherwise(F.col("part"))
    placed = (spread.withColumn("inside", inside).join(sizes, slot)
              .withColumn("start", F.col("slice_start") + F.col("inside")).withColumn("limit", limit).where("start < limit"))
    return placed.select("doc_id", *names, "epoch", "start", F.col("tokens").alias("n_tokens"),
                         F.least("tokens", F.col("limit") - F.col("start")).alias("n_taken"))


def mixed_documents(docs: DataFrame, levels: dict[str, Column], weights: dict[tuple[str, ...], int], share: tuple[int, int],
                    max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, whole, once per epoch; texts are never shuffled.

    A row is taken in an epoch if its key is not beyond that of the last document that the leaf's budget reaches.
    """
    names = list(levels)
    taken = mixture(docs, levels, weights, share, max_epochs, seed)
    key = _order(seed, F.col("epoch"), F.col("doc_id"))
    reach = taken.groupBy(*names, "epoch").agg(F.max(key).alias("_reach")).select(*(F.col(n).alias(f"_{n}") for n in names), F.col("epoch").alias("_epoch"), "_reach")
    epochs = (reach.groupBy(*(f"_{n}" for n in names))
              .agg(F.map_from_entries(F.collect_list(F.struct("_epoch", "_reach"))).alias("_reaches")))  # at most max_epochs entries
    epochs = stored(epochs, "reaches")  # as above: the texts stay where they are
    rows = _with_levels(docs, levels, word_count(F.col("text"))).where("_tokens > 0").join(epochs, [f"_{n}" for n in names])
    rows = rows.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode("_reaches").alias("_epoch", "_reach"))
    return rows.where(_order(seed, F.col("_epoch"), F.col("doc_id")) <= F.col("_reach")).select(*(F.col(f"`{c}`") for c in docs.columns))
