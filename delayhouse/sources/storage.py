"""Keyed replacement of rows in partitioned parquet tables.

One writer per table. The new content of the touched partitions is written beside them as an ordinary table first; Spark's dynamic
partition overwrite then publishes it from that copy, which goes only afterwards. So whatever breaks off in between, the next call
publishes the same copy again, and no stored row is ever only in a half-written place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPACT, Stages, remove

_COPY = "_staged"
#: So many partitions may be written by every task; for more, rows are dealt out by partition first, to keep files few.
FEW_PARTITIONS = 16


def latest(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the last by ``order_by``, ties broken by the whole row.

    A maximum of a struct, not a window: a hot key is combined before the shuffle. The struct is compared row by
    row in sorted order, so callers whose rows are unique by key say so instead (``unique``).
    """
    order = order_by or []
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(*(F.col(c) for c in order), F.struct(*rest).alias("__row"))
    return df.groupBy(*keys).agg(F.max(ranked)["__row"].alias("__row")).select(*keys, "__row.*").select(*df.columns)


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """``target`` with rows replaced or added from ``updates``; the last write per key wins."""
    fresh = latest(updates, keys, order_by)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


# ---- folders


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return fs.exists(location)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is not there."""
    fs, location = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(location)] if fs.exists(location) else []


def stored_partitions(spark: SparkSession, path: str, column: str) -> set[str]:
    """Partition values that the table at ``path`` has a folder for."""
    return {f.split("=", 1)[1] for f in _folders(spark, path) if f.startswith(f"{column}=")}


def settle(spark: SparkSession, path: str, partition_by: str) -> None:
    """Publish the copy that a broken-off call has left complete; drop any other."""
    copy = f"{path}/{_COPY}"
    if path_exists(spark, f"{copy}/rows/_SUCCESS"):
        _publish_copy(spark, path, partition_by)
    if path_exists(spark, copy):
        remove(spark, copy)
    spark.catalog.refreshByPath(path)


def _publish_copy(spark: SparkSession, path: str, partition_by: str) -> None:
    """Overwrite the partitions that the copy has rows of, and remove the touched ones it has none of."""
    copy = f"{path}/{_COPY}"
    rows = spark.read.parquet(f"{copy}/rows")
    values = _partition_values(rows, partition_by)
    dealt = rows if len(values) <= FEW_PARTITIONS else rows.hint("rebalance", partition_by)
    writer = dealt.write.mode("overwrite").options(**COMPACT).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)
    touched = {r[0] for r in spark.read.schema("value string").parquet(f"{copy}/touched").collect()}
    for value in (touched - values) & stored_partitions(spark, path, partition_by):
        remove(spark, f"{path}/{partition_by}={value}")


def publish(spark: SparkSession, path: str, rows: DataFrame, partition_by: str, touched: set[str]) -> None:
    """Make ``rows`` the whole content of the touched partitions; touched ones without rows go."""
    copy = f"{path}/{_COPY}"
    spark.createDataFrame([(v,) for v in sorted(touched)], "value string").coalesce(1).write.mode("overwrite").parquet(f"{copy}/touched")
    rows.write.mode("overwrite").options(**COMPACT).parquet(f"{copy}/rows")
    settle(spark, path, partition_by)


# ---- merges


def _partition_values(df: DataFrame, column: str) -> set[str]:
    """Distinct partition values; as many as there are folders, so small enough for the driver."""
    return {row[0] for row in df.select(F.col(column).cast("string")).distinct().collect()}


def pruned(table: DataFrame, column: str, values: set[str]) -> DataFrame:
    """Rows of the given partitions."""
    kind = table.schema[column].dataType
    return table.filter(F.col(column).isin([F.lit(v).cast(kind) for v in sorted(values)]))


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    partition_by: str,
    order_by: list[str] | None = None,
    keys_may_move: bool = True,
    replace_scope: DataFrame | None = None,
    unique: bool = False,
    also: set[str] | None = None,
    within: set[str] | None = None,
    holding: set[str] | None = None,
) -> set[str]:
    """Merge ``updates`` into the parquet table at ``path``, rewriting only the touched partitions; returns them.

    Rows with a key of ``updates`` are replaced. With ``replace_scope``, a frame of parent keys, every
    stored row of those parents is replaced instead, so children that vanished do not stay behind.
    Touched partitions are those of the new rows, those named in ``also`` and, unless ``keys_may_move`` is off, those
    that now hold a replaced row, found by a scan of the keys. ``unique`` says that no key occurs twice in ``updates``.
    ``within`` names all partitions that new and replaced rows lie in: then nothing is searched, and the rows, which must be cheap
    to compute again, are not written before they are merged. ``holding`` names all partitions that may hold replaced rows; rows of the
    others are kept as they lie, without a comparison. The partition column must not be null. A call that breaks off can be repeated.
    """
    settle(spark, path, partition_by)
    with Stages(spark, **COMPACT) as stages:
        rows = updates if unique else latest(updates, keys, order_by)
        stored = stored_partitions(spark, path, partition_by)
        if not stored:
            # Nothing is compared, so the copy is the only one that is needed.
            publish(spark, path, rows, partition_by, set())
            return _partition_values(spark.read.schema(rows.schema).parquet(path), partition_by)

        fresh = stages.add(rows, "fresh") if within is None else rows
        touched = _partition_values(fresh, partition_by) if within is None else set(within)
        replaced = replace_scope.distinct() if replace_scope is not None else fresh.select(*keys)
        match = replaced.columns
        table = spark.read.schema(fresh.schema).parquet(path)
        if keys_may_move and within is None:
            wanted = table.select(partition_by, *[m for m in match if m != partition_by])
            touched |= _partition_values(wanted.join(replaced, match, "left_semi"), partition_by)
        touched |= (also or set()) & stored
        if touched:
            compared = touched if holding is None else touched & holding
            merged = fresh
            if compared:
                kept = pruned(table, partition_by, compared).join(replaced, match, "left_anti")
                merged = kept.select(*fresh.columns).unionByName(merged)
            if touched - compared:
                merged = pruned(table, partition_by, touched - compared).select(*fresh.columns).unionByName(merged)
            publish(spark, path, merged, partition_by, touched)
        return touched


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, partition_by: str, touched: set[str]) -> None:
    """Overwrite whole partitions with recomputed ``rows``; ``touched`` ones left without rows go."""
    settle(spark, path, partition_by)
    publish(spark, path, rows, partition_by, touched)
