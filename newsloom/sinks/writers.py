"""File and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.frames import BOM


def _as_text(df: DataFrame) -> DataFrame:
    """Arrays as ``['a', 'b']`` text, as delimited files hold no arrays."""
    listed = {
        f.name: F.concat(F.lit("['"), F.array_join(f.name, "', '"), F.lit("']"))
        for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)
    }
    return df.withColumns(listed) if listed else df


def write_csv(df: DataFrame, path: str, *, sep: str = ";", columns: Sequence[str] | None = None,
              bom: bool = True) -> None:
    """Delimited files with a header, optionally only some columns.

    The byte-order mark is part of the first header name, as every part file
    starts with its own header.
    """
    out = _as_text(df.select(*columns) if columns else df)
    if bom:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    out.write.options(header=True, sep=sep, escape='"', emptyValue="", nullValue="").csv(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    df.write.option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def materialize(df: DataFrame, name: str, *, how: str = "table") -> DataFrame:
    """Full refresh of a named model as a table or a view."""
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError("how is 'table' or 'view'")
    return df.sparkSession.table(name)
