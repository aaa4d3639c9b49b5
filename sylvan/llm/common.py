"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.session import ensure_checkpoint_dir, ship

#: Rows per Arrow batch.  Documents can be long, so batches are kept small.
ARROW_ROWS = "1000"
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table, by Spark's own reader."""
    small_batches(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches unless the session already chose a smaller size."""
    if int(spark.conf.get(_ARROW_KEY)) > int(ARROW_ROWS):
        spark.conf.set(_ARROW_KEY, ARROW_ROWS)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names derived from ``names`` that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """Reference to a top-level column whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: Sequence[str]) -> list[Column]:
    return [quoted(n) for n in names]


def utf8(col: Column) -> Column:
    """Text as its UTF-8 bytes, null as no bytes."""
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")
