"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import CSV_TEXT


def write_csv(
    df: DataFrame,
    path: str,
    delimiter: str = ",",
    mode: str = "errorifexists",
    multi_line: bool = False,
    compression: str | None = None,
) -> None:
    """CSV with a header line; quotes inside a field are doubled.

    Blanks around a value and empty strings are kept, a null is written as NULL_MARK. A line
    break inside a value fails unless ``multi_line`` allows it; such files are read with the same
    switch, and then each by one task. So is a file compressed with ``gzip``.
    """
    if not multi_line:
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        message = F.lit("a value with a line break needs multi_line")
        df = df.select(
            *[
                F.when(F.regexp_like(F.col(f"`{name}`"), F.lit("[\\r\\n]")), F.raise_error(message))
                .otherwise(F.col(f"`{name}`"))
                .alias(name)
                if name in texts
                else F.col(f"`{name}`")
                for name in df.columns
            ]
        )
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", delimiter)
        .options(**CSV_TEXT, **({"compression": compression} if compression else {}))
        .csv(path)
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Parquet rows of one batch, in a folder of its own.

    A repeated batch replaces its own rows and no others, also when it has none this time.
    """
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

