"""Generated files of fixed-width lines, and their manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_width(spark: SparkSession, records: int, width: int = 100) -> DataFrame:
    """Lines of ``width`` bytes with their LF: an eight-digit number, then X."""
    if width < 9:
        raise ValueError("width must be at least 9")
    return spark.range(1, records + 1).select(F.concat(F.lpad(F.col("id").cast("string"), 8, "0"), F.lit("X" * (width - 9))).alias("value"))


def write_fixed(spark: SparkSession, path: str, records: int, width: int = 100, force: bool = False) -> DataFrame:
    """Writes the lines as text files; fails if the folder is there, unless forced. The manifest has
    one row per file: records, record_bytes, size_bytes, sha256."""
    fixed_width(spark, records, width).write.mode("overwrite" if force else "error").text(path)
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", (F.col("length") / width).cast("long").alias("records"), F.lit(width).alias("record_bytes"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
