"""Column selection that depends on names or on the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The size column has either name, the first one preferred.
SIZE_COLUMNS = ["Bandwidth", "Bytes"]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep the columns that hold any value. One aggregate over the data decides."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{name}`") for i, name in enumerate(df.columns) if counts[i] > 0])


def size_column(df: DataFrame) -> str:
    for name in SIZE_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError("neither 'Bandwidth' nor 'Bytes' column found")


def with_bandwidth(df: DataFrame) -> DataFrame:
    """The size column under the name ``Bandwidth``."""
    return df.withColumnRenamed(size_column(df), SIZE_COLUMNS[0])


def size_cell(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add ``size``, the cell of the size column of each table; tables are told apart by ``by``.

    A table has the first size column if any of its rows does, also for rows without it.
    """
    first, second = SIZE_COLUMNS
    has_first = rows.groupBy(*by).agg(F.bool_or(F.map_contains_key("cells", first)).alias("has_first"))
    return rows.join(has_first, by).withColumn(
        "size",
        F.when(F.col("has_first"), F.try_element_at("cells", F.lit(first))).otherwise(
            F.try_element_at("cells", F.lit(second))
        ),
    ).drop("has_first")
