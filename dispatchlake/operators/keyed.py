"""Keyed tables: duplicates, current state, timelines and merges.

Nothing here gathers a key's rows into one group. Duplicates and current state are aggregates with
map-side partials; a timeline is range-partitioned on its whole sort order, so one hot key spreads
over many tasks; a merge is one outer join that reads either side once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dispatchlake.session import settle

SMALL_SOURCE = 1 << 16  # bytes up to which a merge computes its source three times rather than shuffle the target


def drop_replays(records: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key where copies are identical (redelivered records)."""
    return records.dropDuplicates(keys)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple of every key (current state, last write wins).

    ``order`` must end in a column that makes the tuple unique, otherwise a tie is open.
    """
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
        .select(*[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in rows.columns])
    )


def keep_one(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key where copies differ: the greatest of the remaining columns, left to right."""
    return latest_per_key(rows, keys, [c for c in rows.columns if c not in keys])


def timeline(rows: DataFrame, key: str, newest_first: list[str]) -> DataFrame:
    """Rows with their position in the key's timeline, newest first (1 = current).

    A window over the key alone would put a hot key into one task. Here rows are range-partitioned
    on (key, time, ...), which may cut a key anywhere; the window ranks inside each cut, and the sizes
    of the key's earlier cuts are added on top. The cut numbers are written down first, because ranking
    and counting must see the same ones.

    Only a key that goes on from one cut into the next has earlier rows, and a cut has at most one such
    key: the table that is broadcast has fewer rows than there are cuts.
    """
    order = [F.desc(c) for c in newest_first]
    cut = settle(
        rows.repartitionByRange(F.col(key), *order).withColumn("_cut", F.spark_partition_id()), "timeline"
    )
    before = W.partitionBy(key).orderBy("_cut").rowsBetween(W.unboundedPreceding, -1)
    continued = (
        cut.groupBy(key, "_cut")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col(key).alias("_key"), F.col("_cut").alias("_of"), F.sum("n").over(before).alias("_earlier"))
        .filter(F.col("_earlier").isNotNull())
    )
    inside = F.row_number().over(W.partitionBy(key, "_cut").orderBy(*order))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_cut") == F.col("_of"))
    return (
        cut.withColumn("_inside", inside)
        .join(F.broadcast(continued), same, "left")
        .select(*rows.columns, (F.col("_inside") + F.coalesce("_earlier", F.lit(0))).alias("position"))
    )


def align(source: DataFrame, target_columns: list[str]) -> DataFrame:
    """Source columns in the target's order under lower-case names; columns the target lacks are dropped."""
    return source.select(*[F.col(c).alias(c.lower()) for c in target_columns])


def primary_key(columns: list[str]) -> list[str]:
    """Orders merge on their id, items on order and item id."""
    return ["order_id", "item_id"] if "item_id" in columns else ["order_id"]


def _same_key(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str] | None = None,
    newest_by: list[str] | None = None,
    spread_nulls: bool = True,
) -> DataFrame:
    """The target after ``source`` was merged into it: matched rows updated, others inserted.

    Source rows that share a key are first reduced to one, so a match is never ambiguous: the newest by
    ``newest_by``, or the greatest row when no order is given.
    """
    keys = keys or primary_key(target.columns)
    aligned = align(source, target.columns)
    staged = latest_per_key(aligned, keys, newest_by) if newest_by else keep_one(aligned, keys)
    return merge_staged(target, staged, keys, spread_nulls)


def merge_staged(
    target: DataFrame, staged: DataFrame, keys: list[str], spread_nulls: bool = True, small: int = SMALL_SOURCE
) -> DataFrame:
    """:func:`merge_upsert` for a source that has the target's columns and every key once.

    One full outer join reads either side once: rows of both are updates, of one side rows that stay or are inserted.
    A target stored by :func:`dispatchlake.operators.sinks.write_buckets` on the keys is not shuffled. A source of
    at most ``small`` bytes, by Spark's estimate, goes to all tasks instead, see :func:`_merge_small`.

    A null key matches nothing: target rows stay, source rows are inserted. Such rows are dealt out by a number
    of their own, so that many of them do not meet in one task. ``spread_nulls=False`` leaves that out, for
    bucketed targets without null keys.
    """
    marked = staged.withColumn("_brought", F.lit(True))
    if estimated_bytes(staged) <= small:
        return _merge_small(target, marked, keys)
    on = list(keys)
    if spread_nulls:
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        target = target.withColumn("_apart", F.when(no_key, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
        marked = marked.withColumn("_apart", F.when(no_key, F.lit(-2)).otherwise(F.lit(-1)).cast("bigint"))
        on.append("_apart")
    joined = target.alias("t").join(marked.alias("s"), _same_key("t", "s", on), "full_outer")
    kept = [c for c in target.columns if c != "_apart"]
    return joined.select(*[F.coalesce(f"t.{c}", f"s.{c}").alias(c) if c in keys else _updated(c) for c in kept])


def _updated(c: str) -> Column:
    return F.when(F.col("s._brought"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)


def _merge_small(target: DataFrame, marked: DataFrame, keys: list[str]) -> DataFrame:
    """A merge that does not shuffle the target: updates by a left join, inserts by the target's key columns alone."""
    joined = target.alias("t").join(marked.alias("s"), _same_key("t", "s", keys), "left")
    updated = joined.select(*[F.col(f"t.{c}") if c in keys else _updated(c) for c in target.columns])
    present = target.select(*keys).join(marked.select(*keys), keys, "left_semi").distinct()
    return updated.unionByName(marked.drop("_brought").join(present, keys, "left_anti"))


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of a plan's result."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def merge_into_table(source: DataFrame, table: str, keys: list[str], newest_by: list[str]) -> None:
    """The same merge run by the table itself, for table formats with row-level updates.

    Parquet tables refuse it; they take :func:`merge_upsert` and a new table version.
    """
    staged = latest_per_key(source, keys, newest_by).alias("source")
    values = {c: F.col(f"source.{c}") for c in source.columns}
    on = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys])
    (
        staged.mergeInto(table, on)
        .whenMatched()
        .update({c: v for c, v in values.items() if c not in keys})
        .whenNotMatched()
        .insert(values)
        .merge()
    )


def append(*loads: DataFrame) -> DataFrame:
    """Loads put after each other by column name, copies kept."""
    return reduce(lambda a, b: a.unionByName(b), loads)


def point_lookup(rows: DataFrame, key: str, value: object) -> DataFrame:
    """Rows of one key; on a stored table the comparison reaches the file scan."""
    return rows.filter(F.col(key) == F.lit(value))


def key_timeline(rows: DataFrame, key: str, value: object, newest_first: list[str]) -> DataFrame:
    """One key's rows, newest first: the read a keyed table serves. Ranks no other key."""
    return point_lookup(rows, key, value).orderBy(*[F.desc(c) for c in newest_first])
