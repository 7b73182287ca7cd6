"""Sinks: named layers, tables, yearly partitions and rasters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.session import settle


def write_layer(df: DataFrame, root: str, layer: str, mode: str = "overwrite") -> str:
    """Write a named layer and return its path."""
    path = f"{root}/{layer}"
    df.write.mode(mode).parquet(path)
    return path


def create_table_as(df: DataFrame, root: str, name: str) -> str:
    """Replace a table by a query result."""
    return write_layer(df, root, name, "overwrite")


def create_table_if_absent(df: DataFrame, root: str, name: str) -> str:
    """Write a table only when there is none yet."""
    return write_layer(df, root, name, "ignore")


def append_rows(df: DataFrame, root: str, name: str) -> str:
    """Add rows to a table."""
    return write_layer(df, root, name, "append")


def write_by_year(df: DataFrame, root: str, layer: str, ts_col: str, whole: bool = False) -> str:
    """Write a table by year; only the years at hand are replaced, or all where the rows are `whole`.

    Rows are rebalanced by year first: few files per year, and a year that is
    too big for one task is split.
    """
    path = f"{root}/{layer}"
    (
        df.withColumn("year", F.year(ts_col))
        .hint("rebalance", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("year")
        .parquet(path)
    )
    return path


def load_by_source(
    df: DataFrame, root: str, layer: str, ts_col: str, source: str = "source_file", version: str | None = None
) -> str:
    """Add the rows of sources that the layer does not hold yet, by year.

    A source is a raw file, named by a column, best by its whole path. One that was loaded
    before adds nothing, whatever years it reaches into, so loads may overlap and repeat
    and every row is held once. A null source counts as one source.

    `version` is a column that changes with the file, such as its size and time. A source
    that is held in another version has changed since: what the layer holds of it is
    replaced. The new years are written aside first and then put in place of the old ones
    by one job, whose commit publishes them together. The sources that are held follow
    from the rows themselves, so no list can disagree with them after a load that broke off.
    """
    path = f"{root}/{layer}"
    spark = df.sparkSession
    df = df.withColumn("year", F.year(ts_col))
    if not layer_exists(spark, path):
        df.hint("rebalance", "year").write.mode("append").partitionBy("year").parquet(path)
        return path
    held = spark.read.parquet(path)
    if version is None or version not in held.columns:
        fresh = _unknown(df, held, source)
    else:
        known = settle(held.groupBy(F.col(source).alias("_held"), F.col(version).alias("_as"), "year").agg(F.lit(1).alias("_one")))
        same = F.col(source).eqNullSafe(F.col("_held"))
        # one row for each source and version, whatever the rows
        given = settle(df.groupBy(source, version).agg(F.lit(1).alias("_one")).drop("_one"))
        fresh = df.join(known, same & F.col(version).eqNullSafe(F.col("_as")), "left_anti")
        old = settle(known.join(given, same & ~F.col(version).eqNullSafe(F.col("_as")), "left_semi"))
        if not old.isEmpty():
            return _replace(spark, held, fresh, old, path, source, version)
    fresh.hint("rebalance", "year").write.mode("append").partitionBy("year").parquet(path)
    return path


def _unknown(df: DataFrame, held: DataFrame, source: str) -> DataFrame:
    """Rows whose source is not held.

    The list of sources is written first: joins then know that it is short, so the rows are
    not shuffled by source, which would put all rows of a source into one task.
    """
    known = settle(held.select(F.col(source).alias("_held")).distinct())
    return df.join(known, F.col(source).eqNullSafe(F.col("_held")), "left_anti")


def _replace(spark: SparkSession, held: DataFrame, fresh: DataFrame, old: DataFrame, path: str, source: str, version: str) -> str:
    """Puts the years of the new rows, and of those that go, in place of what the layer holds of them."""
    fresh = settle(fresh)
    # written, so that joins know that they are short and shuffle no rows by year or source
    years = settle(old.select("year").union(fresh.select("year")).distinct())
    gone = settle(old.select("_held", "_as").distinct())
    stays = held.join(years, held["year"].eqNullSafe(years["year"]), "left_semi").join(
        gone, F.col(source).eqNullSafe(F.col("_held")) & F.col(version).eqNullSafe(F.col("_as")), "left_anti"
    )
    staged = settle(stays.unionByName(fresh.select(held.columns)))
    empty = years.join(staged.select(F.col("year").alias("_filled")).distinct(), F.col("year").eqNullSafe(F.col("_filled")), "left_anti")
    mode = "dynamic"
    if not empty.isEmpty():  # a year that holds nothing any more goes only with the whole table
        rest = held.join(years, held["year"].eqNullSafe(years["year"]), "left_anti")
        staged, mode = settle(rest.unionByName(staged)), "static"
    staged.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("year").parquet(path)
    return path


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds a table."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def append_named_result(df: DataFrame, root: str, layer: str, name: str) -> str:
    """Add a result under a name to a layer; the name is a partition of it."""
    path = f"{root}/{layer}"
    df.withColumn("result", F.lit(name)).write.mode("append").partitionBy("result").parquet(path)
    return path


def write_raster(cells: DataFrame, path: str, band: int = 1024) -> str:
    """Save cells by bands of rows, so that a window of rows reads few files."""
    banded = cells.select("row", "col", "value", F.expr(f"row div {band}").alias("band"))
    banded.hint("rebalance", "band").write.mode("overwrite").partitionBy("band").parquet(path)
    return path
