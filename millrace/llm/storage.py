"""Intermediate tables of this subpackage, written to the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import working_path


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df``, computed once and read back from parquet: later jobs and lost executors reread it."""
    return _written(df, working_path(df.sparkSession, f"llm-{label}"))


class Scratch:
    """Tables of one computation. All are deleted at its end, when what it returns is stored."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = working_path(spark, f"llm-{label}")
        self.tables = 0

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        self.tables += 1
        return _written(df, f"{self.root}/{self.tables}-{label}")

    def stored_by(self, df: DataFrame, label: str, column: str) -> DataFrame:
        """Stored with one folder per value of a column that has few values."""
        self.tables += 1
        path = f"{self.root}/{self.tables}-{label}"
        df.write.partitionBy(column).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, name: str = "") -> None:
        """Remove one table of this computation, or all of them."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.delete()
