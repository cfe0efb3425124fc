"""Warehouse tables as Parquet folders: optional reads, appends, upserts, swaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens import schemas
from forumlens.operators.posts import conform
from forumlens.sources.isolated import ERROR, FILE, read_isolated


def read_optional(spark: SparkSession, *paths: str) -> DataFrame | None:
    """Parquet of those of the given paths or globs that exist, or None when none does.

    Only a missing or empty path is tolerated; any other analysis error is raised.
    """
    there = [path for path in paths if _matches(spark, path)]
    if not there:
        return None
    try:
        return spark.read.parquet(*there)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


#: The partition of a table that batches append to.
BATCH = "loaded_batch"


def read_chunks(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """Every numbered chunk ``{name}_0``, ``{name}_1``, ... and no other table."""
    return read_optional(spark, f"{folder}/{name}_[0-9]*")


def write_table(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "append",
    partition_by: list[str] | None = None,
    rows_per_file: int | None = None,
) -> int:
    """Write under a fixed schema; overwriting replaces only the partitions that are written.

    Partitioned output is rebalanced by its partition values first, so that a value has few files;
    adaptive execution splits a value that holds most of the rows over several tasks. Returns the
    number of rows, observed during the write itself.
    """
    if schema is not None:
        extra = [c for c in partition_by or [] if c not in schema.names]
        df = conform(df.select("*"), T.StructType([*schema.fields, *[df.schema[c] for c in extra]]))
        required = [f.name for f in schema.fields if not f.nullable]
        df = df.select(
            *[
                F.coalesce(F.col(c), F.raise_error(F.lit(f"null in required column {c}")).cast(df.schema[c].dataType)).alias(c)
                if c in required else F.col(c)
                for c in df.columns
            ]
        )
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get.get("rows", 0)


def rewrite_prefix(
    spark: SparkSession,
    source: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    schema: T.StructType | None = None,
    skipped: str | None = None,
) -> int:
    """Rewrite every Parquet file below one prefix to another in one job (A11); how many files gave no row.

    Each file is read by itself: one that is cut off, damaged anywhere or of other types gives none of its rows and
    stops no other. Such files, and those without rows, are listed in ``skipped`` with the reason, by default beside
    the target. A task reads one file, so a narrow ``transform`` gives one output for each input. The list is taken from the
    written pass itself; it holds a row per unreadable file. Without ``schema`` the readable files tell the columns.
    """
    if schema is None:
        below = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet", "ignoreCorruptFiles": "true"}
        schema = spark.read.options(**below).parquet(source).schema
    failed = Observation()
    damaged = F.when(F.col(ERROR).isNotNull(), F.struct(F.col(FILE).alias("path"), F.col(ERROR).alias("reason")))
    read = read_isolated(spark, source, schema).observe(failed, F.collect_set(damaged).alias("files"))
    transform(read.where(F.col(ERROR).isNull()).select(*schema.names)).write.mode("overwrite").parquet(target)
    files = [(r["path"], r["reason"]) for r in failed.get["files"]]
    spark.createDataFrame(files, "path string, reason string").write.mode("overwrite").parquet(skipped or f"{target}.skipped")
    return len(files)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _matches(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return bool(fs.globStatus(hadoop_path))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below a path, none if it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    found = fs.listStatus(hadoop_path) if fs.exists(hadoop_path) else []
    return sorted(f"{path}/{entry.getPath().getName()}" for entry in found if entry.isDirectory())


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The largest value of a table's partition column, from its folder names; no file is opened."""
    fs, hadoop_path = _file_system(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)]
    return max((n.split("=", 1)[1] for n in names if n.startswith(f"{column}=") and "__HIVE" not in n), default=None)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


_ASIDE = ".replaced"


def recover(spark: SparkSession, path: str) -> None:
    """Finish swaps of a table or of its partitions that a failure cut off.

    A folder that was moved aside and has no successor is put back; one whose successor is in
    place is removed. Everything that reads or writes a table calls this first, so a table that
    lies aside is never taken for a new one.
    """
    fs, table = _file_system(spark, path)
    for folder, only in ((table.getParent(), table.getName()), (table, None)):
        if not fs.exists(folder):
            continue
        for entry in fs.listStatus(folder):
            hidden = entry.getPath().getName()
            name = hidden[1 : -len(_ASIDE)]
            if not (hidden.startswith(".") and hidden.endswith(_ASIDE)) or only not in (None, name):
                continue
            _, place = _file_system(spark, f"{folder.toString()}/{name}")
            if fs.exists(place):
                fs.delete(entry.getPath(), True)
            elif not fs.rename(entry.getPath(), place):
                raise OSError(f"cannot put {name} back")


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged folder in the place of a table or partition.

    The old folder is moved aside first, under a hidden name, and removed last: a failure in
    between loses nothing, see ``recover``.
    """
    recover(spark, target)
    fs, new = _file_system(spark, staged)
    _, old = _file_system(spark, target)
    _, aside = _file_system(spark, f"{old.getParent().toString()}/.{old.getName()}{_ASIDE}")
    fs.mkdirs(old.getParent())
    if fs.exists(old):
        if not fs.rename(old, aside):
            raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        raise OSError(f"cannot move {staged} to {target}")
    fs.delete(aside, True)


def swap_partitions(spark: SparkSession, staged: str, target: str) -> None:
    """Put every partition folder of a staged table in the place of the table's own."""
    fs, folder = _file_system(spark, staged)
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if entry.isDirectory() and "=" in name:
            swap(spark, f"{staged}/{name}", f"{target}/{name}")
    fs.delete(folder, True)


def rebuild(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Write ``transform(table)`` beside the table and swap it in."""
    recover(spark, path)
    staged = f"{path}.staged"
    transform(spark.read.parquet(path)).write.mode("overwrite").parquet(staged)
    swap(spark, staged, path)


def append_load(df: DataFrame, path: str, schema: T.StructType, batch: str | None = None) -> None:
    """Append the table's columns by name.

    With ``batch`` the rows become the partition of that batch and replace what an earlier run of
    it loaded, so a load can be repeated.
    """
    recover(df.sparkSession, path)
    if batch is None:
        write_table(df, path, schema, mode="append")
    elif df.isEmpty():  # an overwrite without rows would leave the earlier ones
        remove(df.sparkSession, f"{path}/{BATCH}={batch}")
    else:
        write_table(df.withColumn(BATCH, F.lit(batch)), path, schema, "overwrite", [BATCH])


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in ``source``, and one row per key of ``source``.

    Repeated source keys collapse to their largest row before the join, so the anti join sees
    each key once.
    """
    rest = [c for c in target.columns if c not in keys]
    source = source.select(*keys, *rest)
    if rest:
        best = F.max(F.struct(*rest)).alias("_row")
        source = source.groupBy(*keys).agg(best).select(*keys, "_row.*")
    else:
        source = source.distinct()
    source = source.select(*target.columns)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source)


def upsert_load(
    df: DataFrame, path: str, schema: T.StructType, keys: list[str], partition_by: str | None = None
) -> None:
    """Delete by key, then insert.

    ``partition_by`` names a column that the key determines, such as the day of ``extracted_at``.
    Then only partitions that the source touches are read and replaced; a batch of one day
    rewrites one day, not the table. The result is staged beside the table, since a folder cannot
    be overwritten while it is read, and its folders are moved into place.
    """
    spark = df.sparkSession
    recover(spark, path)
    columns = [*schema.names, *([partition_by] if partition_by and partition_by not in schema.names else [])]
    df = df.select(*columns)
    partitions = [partition_by] if partition_by else None
    if not exists(spark, path):
        fresh = merge_rows(df.limit(0), df, keys)
        write_table(fresh, path, schema, "overwrite", partitions)
        return
    target = spark.read.parquet(path).select(*columns)
    if partition_by:
        # one value per day (or similar) in a batch
        touched = [row[0] for row in df.select(partition_by).distinct().collect()]
        target = target.where(F.col(partition_by).isin(touched))
    staged = f"{path}.staged"
    write_table(merge_rows(target, df, keys), staged, schema, "overwrite", partitions)
    if partition_by:
        swap_partitions(spark, staged, path)
    else:
        swap(spark, staged, path)


def load(df: DataFrame, folder: str, table: str, partition_by: str | None = None, batch: str | None = None) -> None:
    """Load a batch into a table of the contract: upsert where it has a key, else append (M6).

    ``batch`` names the batch of appended rows, which makes the load repeatable.
    """
    schema, keys = schemas.LOAD_KEYS[table]
    path = f"{folder}/{table}"
    if keys:
        upsert_load(df, path, schema, list(keys), partition_by)
    else:
        append_load(df, path, schema, batch)


def write_counted(df: DataFrame, path: str, name: str, mode: str = "append") -> int:
    """Write and return the row count, observed during the write itself."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]
