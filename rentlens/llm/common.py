"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def lower_ascii(col) -> Column:
    """Lower-case A-Z only; NULL counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(F.coalesce(c, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def id_crc(col) -> Column:
    """crc32 of an id written as decimal text (NULL id: of the empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs the tasks it was running and not the stages before them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """A top-level column by its name as it stands (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(columns, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def carried(docs: DataFrame, columns, text: str) -> tuple[DataFrame, T.StructType]:
    """``columns`` of ``docs`` as c0, c1, ... and the text as ``t``, for a Python stage; the schema of c0, c1, ...

    The names clash with nothing that the stage adds, whatever the columns are called.
    """
    df = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(columns)], column(text).cast("string").alias("t"))
    return df, T.StructType(df.schema.fields[:-1])


def given_back(df: DataFrame, columns, results) -> DataFrame:
    """c0, c1, ... under their own names again, then ``results``."""
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], *results)
