"""Mixing sources to target weights by Pareto order sampling (Rosen, 1997).

Every source gets a target number of words. A document's whole copies are
certain; what is left of the target goes to a sample with inclusion
probabilities in proportion to document size. Each document draws a fixed
uniform ``u`` from its id and is ranked by its random odds ``u / (1 - u)``
divided by its inclusion odds ``p / (1 - p)``; the sample is the head of that
ranking whose words come nearest to what is left. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starweave.llm.common import WORD_CLASS, stored

#: Steps in which a source's ranking is summed before the step that holds the cut is looked at row by row.
STEPS = 65_536


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by the id: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / 4503599627370496.0


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, source_size)``, one row per source.

    Sources in code-point order, null last, take the weights in turn. A target
    stops at ``most`` times its source; the excess is shared among the others
    by weight. Those that stop are a prefix of the order by
    ``most * source_size / weight``, so running sums give the level at once.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1))
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = W.orderBy("ratio", F.col("source").isNull(), F.encode("source", "UTF-8"))
    up_to = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    on = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # the level if all before this source stop and this and all after do not
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))) / F.sum("weight").over(on)
    rows = rows.withColumn("level", level).withColumn("at", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(every)["level"]
    # without such a source all of them stop
    return rows.select("source", "source_size", F.least("cap", F.col("weight") * first).alias("target"))


def _ranked(rows: DataFrame, seed: str) -> DataFrame:
    """Adds ``q`` and ``step`` to rows that have ``doc_id, size`` and their source's ``scale``.

    ``q`` is random odds over inclusion odds: 0 for certain documents, null
    for those that can't be drawn.
    """
    rows = rows.withColumn("p", F.least(F.lit(1.0), F.col("scale") * F.col("size")))
    rows = rows.withColumn("u", uniform(F.col("doc_id"), seed))
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    rows = rows.withColumn("q", F.when(F.col("p") > 0, odds))
    return rows.withColumn("step", F.floor(F.col("q") / (1 + F.col("q")) * STEPS).cast("int"))


def _place() -> Column:
    """Order within a source: rank, then id (null last), then size."""
    return F.struct(F.col("q"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("size"))


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """One stored row per source: target, certain copies, and where the ranking is cut.

    Only ``(id, source, size)`` leaves the scan of the texts. Sums per source
    and per step of the ranking combine map-side, so a source with a third of
    the rows costs no task more than a step of it.
    """
    size = words(F.col(text_col)).alias("size")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), size)
    rows = stored(narrow, "mix-sizes")
    by_size = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-by-size")
    totals = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(totals, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("base", copies.cast("int"))
    goal = goal.withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
    goal = stored(goal, "mix-targets")

    # inclusion probability min(1, scale * size), with expected words equal to the rest
    by_largest = W.partitionBy("source").orderBy(F.desc("size"))
    held = by_size.withColumn("words", (F.col("size") * F.col("n")).cast("decimal(38,0)"))
    held = held.withColumn("square", (F.col("size") * F.col("words")).cast("decimal(38,0)"))
    above = F.sum("words").over(by_largest.rowsBetween(W.unboundedPreceding, -1))
    squares = F.sum("square").over(by_largest.rowsBetween(W.currentRow, W.unboundedFollowing))
    held = held.select(
        F.col("source").alias("s"), "size",
        F.coalesce(above, F.lit(0)).cast("double").alias("above"), squares.cast("double").alias("squares"),
    )
    held = held.join(goal, F.col("source").eqNullSafe(F.col("s")))
    scale = F.when(F.col("squares") > 0, (F.col("rest") - F.col("above")) / F.col("squares"))
    held = held.withColumn("scale", scale).where("scale * size <= 1")
    scales = held.groupBy("s").agg(F.max(F.struct("size", "scale"))["scale"].alias("scale"))
    goal = goal.join(scales, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    goal = stored(goal.withColumn("scale", F.coalesce("scale", F.lit(0.0))), "mix-scales")

    # the step of the ranking in which a source's rest is reached
    mine = goal.select(F.col("source").alias("s"), "scale", "rest")
    ranked = _ranked(rows.join(mine, F.col("source").eqNullSafe(F.col("s"))), seed).where("p > 0").drop("s")
    steps = ranked.groupBy("source", "step", "rest").agg(F.sum("size").alias("words"))
    so_far = W.partitionBy("source").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    cut = steps.where("before <= rest and rest < before + words")
    cut = stored(cut.select(F.col("source").alias("s"), F.col("step").alias("cut_step"), "before"), "mix-steps")

    # and within that step the row: a document is taken if the rest reaches its middle
    near = ranked.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("step") == F.col("cut_step"))).drop("s")
    earlier = F.sum("size").over(W.partitionBy("source").orderBy(_place()).rowsBetween(W.unboundedPreceding, -1))
    near = near.withColumn("middle", F.col("before") + F.coalesce(earlier, F.lit(0)) + F.col("size") / 2)
    last = near.where("middle <= rest").groupBy(F.col("source").alias("t")).agg(F.max(_place()).alias("cut"))
    goal = goal.join(cut.drop("before"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    goal = goal.join(last, F.col("source").eqNullSafe(F.col("t")), "left").drop("t")
    return stored(goal, "mix-plan")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    out: str = "mix",
) -> DataFrame:
    """``docs`` with a column ``out``: struct of ``size, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` its words
    times that. The texts are scanned twice and never shuffled: the plan has
    one row per source and is joined to the scan.

    Null text has size 0 and a source of only such documents has target 0.
    Null is a source of its own, ordered last. Documents without words are
    taken as often as their source's certain copies. Rows with one id and size
    draw the same number and are taken or left together. Columns of ``docs``
    keep their names and values whatever they are called, except one called
    ``out``, which is replaced. An empty table gives an empty result.
    """
    goal = plan(docs, id_col, text_col, source_col, weights, share, most, seed)
    goal = goal.select(F.struct(*goal.columns).alias("__goal"))
    own = [docs[c] for c in docs.columns if c != out]
    key = F.struct(
        docs[id_col].cast("long").alias("doc_id"), docs[source_col].alias("source"), words(docs[text_col]).alias("size")
    )
    rows = docs.select(F.struct(*own).alias("__row"), key.alias("__key"))
    rows = rows.join(goal, F.col("__key.source").eqNullSafe(F.col("__goal.source")), "left")
    settled = ("source_size", "target", "base", "scale", "cut_step", "cut")
    rows = _ranked(rows.select("__row", "__key.*", *[F.col(f"__goal.{c}").alias(c) for c in settled]), seed)
    at_cut = (F.col("step") == F.col("cut_step")) & (_place() <= F.col("cut"))
    chosen = F.coalesce((F.col("step") < F.col("cut_step")) | at_cut, F.lit(False))
    rows = rows.withColumn("copies", F.col("base") + chosen.cast("int"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("__row.*", F.struct("size", "source_size", "target", "copies", taken).alias(out))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with the columns of ``docs``."""
    mixed = mix(docs, out="__mix", **options)
    times = F.explode(F.expr("if(__mix.copies > 0, sequence(1, __mix.copies), array())"))
    return mixed.select("*", times.alias("__copy")).drop("__mix", "__copy")
