"""What the text operators share: reading a table, ASCII case folding, written intermediates."""

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from downfold.session import work_folder, written

__all__ = ["folded", "md5_halves", "read_table", "rows_of", "work_folder", "written"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def folded(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def md5_halves(text: Column) -> list[Column]:
    """128 bits that stand for ``text`` where rows of a text must find each other again."""
    hexed = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return [
        F.conv(F.substring(hexed, start, 16), 16, -10).cast("long").alias(name)
        for name, start in (("t1", 1), ("t2", 17))
    ]


def rows_of(df: DataFrame, schema: StructType | str) -> DataFrame:
    """An empty frame of the session of ``df``."""
    return df.sparkSession.createDataFrame([], schema)
