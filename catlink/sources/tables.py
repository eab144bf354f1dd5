"""Catalog tables: scans, declared remote queries, table replacement, CSV output, state tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from catlink.config import Catalog
from catlink.functions.text import name_key
from catlink.operators.keys import numbered


def read_catalog(spark: SparkSession, folder: str, schemas: dict[str, str], names: Iterable[str] | None = None) -> Catalog:
    """Parquet folder per table, read with its declared schema."""
    wanted = list(names) if names is not None else list(schemas)
    return Catalog({n: spark.read.schema(schemas[n]).parquet(f"{folder}/{n}") for n in wanted})


def read_jdbc(spark: SparkSession, url: str, table: str, split: str | None = None, bounds: tuple[int, int] | None = None,
              parts: int = 64, **options: str) -> DataFrame:
    """Table scan over JDBC, read in parallel when a split column and its bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split and bounds:
        reader = reader.options(partitionColumn=split, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def declared(df: DataFrame, schema: str) -> DataFrame:
    """Give a query result a declared schema by position, as ``AS t(col type, …)`` does.

    A value that does not fit its declared type is an error (ANSI casts).
    """
    fields = StructType.fromDDL(schema).fields
    if len(fields) != len(df.columns):
        raise ValueError(f"query returns {len(df.columns)} columns, {len(fields)} are declared")
    renamed = df.toDF(*[f"_{i}" for i in range(len(fields))])
    return renamed.select([F.col(f"_{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def resolve_name(entity: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Replace a name id by its text from the name table ``(id, name)``."""
    lookup = names.select(F.col("id").alias("_nid"), F.col("name").alias("_text"))
    joined = entity.join(lookup, entity[column] == F.col("_nid"))
    return joined.select([F.col("_text").alias(c) if c == column else entity[c] for c in entity.columns])


def lookup_map(df: DataFrame, key: str = "name", value: str = "id") -> DataFrame:
    """Dictionary (lower-case key -> id); the highest id wins for a repeated key."""
    return df.groupBy(name_key(key).alias("key")).agg(F.max(value).alias("value"))


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Drop the table if it exists and create it from the query result."""
    spark = df.sparkSession
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV without header; NULL is an empty field, the empty string a quoted one, quotes are doubled."""
    df.write.mode("overwrite").option("header", "false").option("escape", '"').option("emptyValue", '""').option("nullValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # a null marker that cannot occur keeps quoted empty fields apart from absent ones
    return spark.read.schema(schema).option("escape", '"').option("emptyValue", "").option("nullValue", "\u0000").csv(path)


# Keyed state -------------------------------------------------------------------------------


def upsert(state: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], keep_old: Sequence[str] = ()) -> DataFrame:
    """State after applying the incoming rows in ``order``; the last row of a key wins.

    Columns in ``keep_old`` are not erased by a NULL: the last non-NULL value stays. ``order``
    columns exist in ``incoming`` only. Runs as one aggregation with map-side combining.
    """
    values = [c for c in state.columns if c not in keys]
    missing = [c for c in state.columns if c not in incoming.columns]
    old = state.select(*state.columns, F.lit(0).alias("_round"), *[F.lit(None).cast(incoming.schema[c].dataType).alias(f"_o_{c}") for c in order])
    new = incoming.select(
        *[F.lit(None).cast(state.schema[c].dataType).alias(c) if c in missing else F.col(c).cast(state.schema[c].dataType) for c in state.columns],
        F.lit(1).alias("_round"), *[F.col(c).alias(f"_o_{c}") for c in order])
    rank = [F.col("_round"), *[F.col(f"_o_{c}") for c in order]]

    def last(c: str):
        if c in keep_old or c in missing:
            rank_if_set = F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c).alias("v")))
            return F.max(rank_if_set)["v"].alias(c)
        return F.max(F.struct(*rank, F.col(c).alias("v")))["v"].alias(c)

    return old.unionByName(new).groupBy(*keys).agg(*[last(c) for c in values]).select(*state.columns)


def insert_ignore(state: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is new, the first row in ``order`` per key."""
    values = [c for c in incoming.columns if c not in keys]
    others = [c for c in values if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others]))
    picked = incoming.groupBy(*keys).agg(first.alias("_f")).select(*keys, *[F.col("_f")[c].alias(c) for c in values])
    return picked.join(state.select(*keys).distinct(), list(keys), "left_anti").select(*incoming.columns)


def pending(items: DataFrame, done: str = "done") -> DataFrame:
    """Rows not yet marked done (NULL counts as neither done nor pending)."""
    return items.filter(F.col(done) == F.lit(False))


def mark_done(items: DataFrame, finished: DataFrame, key: str, done: str = "done") -> DataFrame:
    """Set the flag on every finished key."""
    marks = finished.select(key).distinct().withColumn("_hit", F.lit(True))
    return items.join(marks, key, "left").withColumn(done, F.coalesce("_hit", F.col(done))).select(*items.columns)


# Audit log -----------------------------------------------------------------------------------


def log_event(log: DataFrame, events: DataFrame) -> DataFrame:
    """Log rows for ``events (updated, event[, timest])``, numbered after the last one."""
    last = F.coalesce(log.agg(F.max("id")).scalar(), F.lit(0))
    stamped = events if "timest" in events.columns else events.withColumn("timest", F.current_timestamp())
    rows = numbered(stamped, [], ["updated", "event"], F.coalesce("updated", F.lit("")), "_nr")
    return rows.select((last + F.col("_nr")).cast("long").alias("id"), "updated", "event", "timest")


def latest_events(log: DataFrame, n: int = 4) -> DataFrame:
    return log.orderBy(F.desc("id")).limit(n)
