"""Small column helpers shared by the modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def quote(name: str) -> str:
    """Back-quote a column name for use inside a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"


def literal_frame(spark, rows: list[tuple], names: list[str]):
    """A small fixed table built JVM-side from literals (no Python RDD).

    Only for tables whose size is fixed by the code (dimensions, check lists).
    """
    structs = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
