"""Reading, staging and appending plain tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from histflow.operators.spread import placement
from histflow.session import cleared_shuffles, owned_folders, remove_folder, work_folder


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def dealt_out(df: DataFrame, tasks: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """A table dealt out to ``tasks`` before heavy per-row work.

    For tables of few files: a file of one row group is read by a single task, and
    parsing JSON costs far more than reading it. Dealt out ``by`` the columns that the rows are
    grouped by later, they stay where they are for that: texts made of them do not move.
    """
    spark = df.sparkSession
    least = spark.sparkContext.defaultParallelism
    if by:
        return df.repartition(tasks or max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)
    return df.repartition(tasks or least)


def pending(df: DataFrame, flag: str = "indicator_flag", value: str = "N") -> DataFrame:
    """Rows not processed yet. A plain comparison, so the scan can use it."""
    return df.where(F.col(flag) == value)


def literal_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A few rows written out in code; structured payloads may be Python objects."""
    return spark.createDataFrame(list(rows), schema)


def json_payload(fields: Mapping[str, Column]) -> Column:
    """A payload of one object, built from columns; NULL fields stay as null."""
    record = F.struct(*[c.alias(name) for name, c in fields.items()])
    return F.to_json(F.array(record), {"ignoreNullFields": "false"})


def bound_query(spark: SparkSession, query: str, **parameters) -> DataFrame:
    """Run a query with bound values; ``IDENTIFIER(:name)`` binds a table."""
    return spark.sql(query, args=parameters)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back.

    Ids and clock values are fixed from here on, lineage ends here, and a lost
    executor costs nothing but the files' re-read. The shuffle files of the write go
    with its end.
    """
    return _written(df, work_folder(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with cleared_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_folder = path
    return out


def stage_result(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make()`` returns, staged; the folders that were staged for it go."""
    path = work_folder(spark, name)  # of the scope outside
    with owned_folders(spark):
        return _written(make(), path)


def discard(*staged: DataFrame) -> None:
    """Delete staged rows that nothing is computed from any more; rows that are not staged are passed over."""
    for df in staged:
        if (path := getattr(df, "staged_folder", None)) is not None:
            remove_folder(df.sparkSession, path)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a table by name; missing ones as typed NULLs, others dropped."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target with the rows appended by name."""
    return target.unionByName(align(rows, target.schema))


def append_named(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Append to a table by column name, never by position."""
    align(rows, schema).write.mode("append").parquet(path)


def constrained(
    df: DataFrame, schema: T.StructType | str, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows that keep a declared table's constraints, in its columns, and the others as they came.

    Files do not enforce what a schema declares: a NOT NULL column may hold NULLs, and text
    may not be a value of its column's type. A row that breaks a constraint comes back
    with ``violated``, the names of the columns concerned; a missing NOT NULL column is violated by
    every row. ``observation`` counts ``rows`` and the violations of each column while the kept rows are written.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    present = {c.lower(): c for c in df.columns}
    broken = {}
    for f in declared.fields:
        there = f.name.lower() in present
        value = F.col(present[f.name.lower()]) if there else F.lit(None)
        bad = F.lit(False)
        if there and df.schema[present[f.name.lower()]].dataType != f.dataType:
            bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
        if not f.nullable:
            bad = bad | value.isNull()
        broken[f.name] = bad
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()]))
    checked = df.withColumn("violated", names)
    counted = checked
    if observation is not None:
        counts = [F.count_if(F.array_contains("violated", name)).alias(name) for name in broken]
        counted = checked.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
    return align(counted.where(F.size("violated") == 0), declared), checked.where(F.size("violated") > 0)


def _clustered(df: DataFrame, day: str, cluster_by: Sequence[str]) -> DataFrame:
    """Rows in balanced ranges of (day, cluster columns, slice), sorted inside."""
    keys = [F.col(c) for c in [day, *cluster_by]]
    sliced = df.withColumn("__slice", placement(df, 1 << 20))
    return sliced.repartitionByRange(*keys, "__slice").drop("__slice").sortWithinPartitions(*keys)


def layout_write(
    df: DataFrame,
    path: str,
    time: str,
    cluster_by: list[str],
    day: str = "load_dt",
) -> None:
    """A table partitioned by day and clustered inside each day.

    Rows are range-partitioned on (day, cluster columns, slice): the ranges are
    balanced even if one day, or one id, holds a third of the rows, and sorted
    files let the scan skip row groups by their min/max. Days that the table
    has already get further files; :func:`layout_compact` orders them again.
    """
    _clustered(df.withColumn(day, F.to_date(time)), day, cluster_by).write.mode("append").partitionBy(day).parquet(path)


def layout_overlap(table: DataFrame, cluster: str, day: str = "load_dt") -> DataFrame:
    """For each day its ``files`` and their ``depth``: how many of them hold a value at most, by their least and greatest one.

    Reads the cluster column alone; what is shuffled is a row per file.
    """
    files = (
        table.select(day, F.col(cluster).alias("at"), F.input_file_name().alias("file"))
        .groupBy(day, "file")
        .agg(F.min("at").alias("least"), F.max("at").alias("most"))
    )
    border = F.inline(F.array(F.struct(F.col("least").alias("at"), F.lit(1).alias("step")), F.struct(F.col("most").alias("at"), F.lit(-1).alias("step"))))
    # A file that ends where another begins still holds that value.
    order = Window.partitionBy(day).orderBy("at", F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    edges = files.select(day, border).withColumn("depth", F.sum("step").over(order))
    return edges.groupBy(day).agg(F.max("depth").alias("depth"), (F.count(F.lit(1)) / 2).cast("long").alias("files"))


def layout_compact(spark: SparkSession, path: str, cluster_by: list[str], day: str = "load_dt", most: int = 2) -> list:
    """Write the days anew whose files overlap more than ``most`` deep; which they were.

    Only those days are read and written, by dynamic partition overwrite. A day whose depth comes from one
    value with more rows than a file takes stays that deep.
    """
    table = spark.read.parquet(path)
    crowded = [r[0] for r in layout_overlap(table, cluster_by[0], day).where(F.col("depth") > most).select(day).collect()]  # a row per day
    if crowded:
        rows = stage(table.where(F.col(day).isin(crowded)), "crowded-days")
        _clustered(rows, day, cluster_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
        spark.catalog.refreshByPath(path)
    return sorted(crowded)


def bucketed_write(df: DataFrame, table: str, path: str, by: list[str], buckets: int) -> None:
    """A table bucketed for joins on ``by`` that need no shuffle of this side.

    A bucket's rows are dealt to several tasks, so one id with a large share of
    the rows is written by all of them; each bucket has a few files.
    """
    (
        df.withColumn("__slice", placement(df, 8))
        .repartition(buckets, *by, "__slice")
        .drop("__slice")
        .write.mode("overwrite")
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", path)
        .saveAsTable(table)
    )
