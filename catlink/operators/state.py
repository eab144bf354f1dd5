"""Work lists and their state: ledgers, queue drains, edit guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def not_processed(items: DataFrame, ledger: DataFrame, lang: str | None = None, key: str = "gid") -> DataFrame:
    """Items that the ledger does not list (for the language, if one is given)."""
    done = ledger if lang is None else ledger.filter(F.col("lang") == lang)
    return items.join(done.select(key).distinct(), key, "left_anti").select(*items.columns)


def record_processed(items: DataFrame, lang: str | None = None, key: str = "gid") -> DataFrame:
    """Ledger rows to append."""
    cols = [F.col(key)] + ([F.lit(lang).alias("lang")] if lang else []) + [F.current_timestamp().alias("processed")]
    return items.select(key).distinct().select(*cols)


def drain(queue: DataFrame, n: int, order: Sequence[Column | str], keys: Sequence[str], distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """(batch, rest): the first ``n`` rows, and the queue without any row of their keys.

    ``order`` should be total, otherwise ties at the cut may differ between runs.
    """
    rows = queue.distinct() if distinct else queue
    batch = rows.orderBy(*order).limit(n)
    rest = queue.join(batch.select(*keys).distinct(), list(keys), "left_anti").select(*queue.columns)
    return batch, rest


SET, ALREADY_SET, CHANGED = "set", "already set", "changed, abort"


def guard(current: Column, old: Column, new: Column, new_first: bool = False) -> Column:
    """Outcome of one proposed change given the current value (NULL and the empty text are equal).

    ``new_first`` reports "already set" even when the value is not the expected old one.
    """
    c, o, n = (F.coalesce(x.cast("string"), F.lit("")) for x in (current, old, new))
    done = F.when((c == n) & (n != o), ALREADY_SET) if new_first else None
    stale = done.when(c != o, CHANGED) if done is not None else F.when(c != o, CHANGED)
    if new_first:
        return stale.otherwise(SET)
    return stale.when(c == n, ALREADY_SET).otherwise(SET)


def guard_empty(current: Column) -> Column:
    """Outcome of a change that only fills an empty field."""
    return F.when(F.coalesce(current.cast("string"), F.lit("")) != "", ALREADY_SET).otherwise(SET)


def edit_guard(proposals: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Proposals ``(keys, field, old, new)`` with the outcome of each entity's edit.

    ``current`` is ``(keys, field, value)``. An edit is aborted when one of its fields has
    changed, and left alone when every field has its new value already.
    """
    now = current.select(*keys, "field", F.col("value").alias("_value"))
    rows = proposals.join(now, [*keys, "field"], "left").withColumn("_r", guard(F.col("_value"), F.col("old"), F.col("new")))
    per = rows.groupBy(*keys).agg(F.bool_or(F.col("_r") == CHANGED).alias("changed"), F.bool_or(F.col("_r") == SET).alias("differs"))
    outcome = F.when(F.col("changed"), CHANGED).when(F.col("differs"), SET).otherwise(ALREADY_SET)
    return per.select(*keys, outcome.alias("outcome"))
