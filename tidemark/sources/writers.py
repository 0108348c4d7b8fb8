"""Writers: CSV, dated partitions, unmatched reports, tables swapped in whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_days(df: DataFrame, path: str, day: str = "date") -> None:
    """Rewrites only the days that ``df`` holds (a rolling index)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_months(df: DataFrame, path: str, day: str = "date") -> None:
    """Months as partitions; only the months that ``df`` holds are rewritten."""
    out = df.withColumn("ym", F.date_format(day, "yyyy-MM"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)


def swap_in(df: DataFrame, path: str) -> None:
    """Writes a whole table beside the old one and swaps the folders, so readers see one or the other."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.staging")
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = fs_path(f"{path}.old")
    fs.delete(old, True)
    if fs.exists(fs_path(path)):
        fs.rename(fs_path(path), old)
    fs.rename(fs_path(f"{path}.staging"), fs_path(path))
    fs.delete(old, True)


def unmatched(df: DataFrame, name: str, known: DataFrame, known_name: str) -> DataFrame:
    """``(name, n)`` of names that the known list lacks, most frequent first by the caller's sort."""
    return df.join(known.select(F.col(known_name).alias(name)).distinct(), name, "left_anti").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` widened by typed null columns it lacks."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
