"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target share of all words. A document's expected copies are its source's target over its source's size (times an
optional weight of its own): the whole part is taken for certain, the fraction is its inclusion probability. Documents are ranked by
Pareto's ratio, the odds of a uniform draw over the odds of inclusion, and taken in that order while they fit into the source's words;
one more document, the one of the best size, fills the gap at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from catlink import session
from catlink.llm.common import uniform, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKETS = 4096
"""Rank buckets of a source: only the bucket that holds the cut is ever sorted."""


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> and target: shares of all words by weight, none over ``cap`` times its source.

    Sources by code point, null last, weigh ``weights`` over and over. The excess of capped sources is shared again by weight; in
    ascending order of cap over weight that has a closed form, so no rounds are needed. Sources without words get 0.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    df = sizes.withColumn("_w", F.element_at(weight, ((row - 1) % len(weights) + 1).cast("int")))
    df = df.withColumn("_cap", F.col("source_size") * float(cap)).withColumn("_total", F.sum("source_size").over(everything).cast("double"))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    capped = F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumn("_level", (F.col("_total") - capped) / rest)
    df = df.withColumn("_open", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")))
    # The first source that stays open sets the level; later ones, reckoned with it capped, come out lower.
    target = F.least(F.col("_cap"), F.max("_open").over(everything) * F.col("_w"))
    return df.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _ratio(u: Column, p: Column) -> Column:
    """Pareto's ranking number, folded into [0, 1): odds of u over odds of p, as x / (1 + x)."""
    return F.when(p <= 0, F.lit(1.0)).when(p >= 1, F.lit(0.0)).otherwise(u * (1 - p) / (u * (1 - p) + (1 - u) * p))


def _keyed(docs: DataFrame, weight: str | None) -> DataFrame:
    """Rows with the columns the decision takes: draw, tie hash and weight."""
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(1.0)), F.lit(0.0)) if weight else F.lit(1.0)
    tie = F.md5(F.coalesce(F.col("text"), F.lit("")))
    u = F.when(F.col("doc_id").isNull(), uniform("doc_id", tie)).otherwise(uniform("doc_id"))  # null ids draw by their texts, so that none is hot
    return docs.withColumns({"_u": u, "_tie": tie, "_weight": w, "_sized": F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))})


def _rank(df: DataFrame, cap: float) -> DataFrame:
    """Add whole copies, the inclusion probability of the rest, and the ranking number, from ``_rate`` and ``_weight``."""
    expected = F.least(F.col("_rate") * F.col("_weight"), F.lit(float(cap)))
    df = df.withColumn("_expected", F.coalesce(expected, F.lit(0.0)))
    df = df.withColumn("_whole", F.floor("_expected").cast("long"))
    part = F.col("_expected") - F.col("_whole")
    df = df.withColumns({"_rank": _ratio(F.col("_u"), part), "_part": (part > 0) & F.col("_sized")})
    return df.withColumn("_bucket", F.least(F.floor(F.col("_rank") * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))


def _within() -> Column:
    """Whether a ranked row lies before the end of its source's sample."""
    here = F.coalesce(F.struct("_rank", "doc_id", "_tie") <= F.col("_last"), F.lit(False))
    return F.coalesce((F.col("_bucket") < F.col("_at")) | ((F.col("_bucket") == F.col("_at")) & here), F.lit(False))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


class Mix:
    """The decision over a table: per source its target, rate and the rank at which taking stops."""

    def __init__(self, docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, weight: str | None = None):
        self.cap, self.weight = cap, weight
        keyed = _keyed(docs, weight)
        narrow = keyed.select("doc_id", "source", word_count(F.col("text")).alias("size"), "_u", "_tie", "_weight", "_sized")
        self.rows = session.materialise(narrow, "mix-rows")
        sizes = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_weight")).alias("_weighted"))
        goal = targets(sizes.select("source", "source_size"), weights, cap).withColumnRenamed("source", "_s")
        plan = sizes.join(goal.drop("source_size"), _same("source", "_s")).drop("_s")
        rate = F.when(F.col("_weighted") > 0, F.col("target") / F.col("_weighted")).otherwise(0.0)
        plan = session.materialise(plan.select(F.col("source").alias("_s"), "source_size", "target", rate.alias("_rate")), "mix-plan")
        self.plan = self._cuts(plan)

    def _with(self, rows: DataFrame, plan: DataFrame) -> DataFrame:
        return rows.join(plan, _same("source", "_s"), "left").drop("_s")

    def _cuts(self, plan: DataFrame) -> DataFrame:
        ranked = _rank(self._with(self.rows, plan), self.cap)
        # Words by rank bucket, pre-aggregated; the whole copies of a source come off its target.
        words = F.sum(F.when(F.col("_part"), F.col("size")).otherwise(0))
        buckets = ranked.groupBy("source", "_bucket").agg(words.alias("_words"), F.sum(F.col("size") * F.col("_whole")).alias("_sure"), F.first("target").alias("_target"))
        source = Window.partitionBy("source")
        need, upto = F.col("_target") - F.sum("_sure").over(source), F.sum("_words").over(source.orderBy("_bucket"))
        buckets = buckets.select(F.col("source").alias("_s"), "_bucket", need.alias("_need"), upto.alias("_upto"))
        at = F.when(F.first("_need") <= 0, -1).otherwise(F.coalesce(F.min(F.when(F.col("_upto") >= F.col("_need"), F.col("_bucket"))), F.lit(BUCKETS)))
        before = F.coalesce(F.max(F.when(F.col("_upto") < F.col("_need"), F.col("_upto"))), F.lit(0))
        cuts = buckets.groupBy("_s").agg(at.alias("_at"), (F.first("_need") - before).alias("_left"))
        # In the bucket of the cut, the last document is the last one that fits.
        inside = ranked.filter("_part").join(cuts, _same("source", "_s") & (F.col("_bucket") == F.col("_at")))
        order = source.orderBy("_rank", "doc_id", "_tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        inside = inside.withColumn("_sum", F.sum("size").over(order)).filter("_sum <= _left")
        unit = F.struct("_rank", "doc_id", "_tie")
        best = inside.groupBy("source").agg(F.max(unit).alias("_last"), F.max("_sum").alias("_got"))
        out = plan.join(cuts.withColumnRenamed("_s", "_c"), _same("_s", "_c"), "left").join(best.withColumnRenamed("source", "_b"), _same("_s", "_b"), "left")
        out = out.withColumn("_gap", F.when(F.col("_at").between(0, BUCKETS - 1), F.col("_left") - F.coalesce("_got", F.lit(0))))
        ends = session.materialise(out.select("_s", "source_size", "target", "_rate", "_at", "_last", "_gap"), "mix-cuts")
        # What is left, less than one document in rank order, goes to the document not yet taken that fits it best.
        open_ = _rank(self._with(self.rows, ends), self.cap).filter(F.col("_part") & ~_within() & (F.col("size") < 2 * F.col("_gap")))
        extra = open_.groupBy("source").agg(F.min_by(unit, F.struct(F.abs(F.col("size") - F.col("_gap")), unit)).alias("_extra"))
        out = ends.join(extra.withColumnRenamed("source", "_b"), _same("_s", "_b"), "left")
        return session.materialise(out.select("_s", "source_size", "target", "_rate", "_at", "_last", "_extra"), "mix-ends")

    def decide(self, rows: DataFrame) -> DataFrame:
        """Add source_size, target and copies to rows with draw, tie hash and weight."""
        df = _rank(self._with(rows, self.plan), self.cap)
        chosen = F.col("_part") & (_within() | F.coalesce(F.struct("_rank", "doc_id", "_tie") == F.col("_extra"), F.lit(False)))
        return df.withColumn("copies", F.col("_whole") + F.coalesce(chosen, F.lit(False)).cast("long"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, weight: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document.

    A null text has no words and is never sampled; null sources are one source, the last; equal rows are taken alike; an empty table
    gives no rows. ``weight`` names a column of relative inclusion weights (null: 1).
    """
    m = Mix(docs, weights, cap, weight)
    out = m.decide(m.rows)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, weight: str | None = None) -> DataFrame:
    """The mixed documents with the columns they had: each row as often as it is taken.

    The row travels as one struct, so no column of the table can clash with a name used here.
    """
    m = Mix(docs, weights, cap, weight)
    given = [F.col(f"`{weight}`").alias("_given")] if weight else []
    keyed = _keyed(docs.select("doc_id", "text", "source", *given, F.struct("*").alias("_row")), "_given" if weight else None).drop("text")
    out = m.decide(keyed).filter("copies > 0")
    return out.select("_row", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).select("_row.*")
