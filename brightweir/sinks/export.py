"""CSV mirror and text matrix of the output tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StructType

from brightweir import fixed_values as fixed
from brightweir.operators.dedup import read_table


# Cells keep their white space; a quote inside a cell is doubled.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _as_text(name: str, kind: DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, BooleanType):
        column = column.cast("int")
    elif isinstance(kind, (ArrayType, StructType)):
        column = F.to_json(column)
    return column.cast("string").alias(name)


def flat_text(df: DataFrame) -> DataFrame:
    """Every column as text: booleans as 0 and 1, lists and structs as JSON."""
    return df.select(*[_as_text(f.name, f.dataType) for f in df.schema.fields])


def text_matrix(df: DataFrame) -> DataFrame:
    """Every cell as text, null as an empty string."""
    flat = flat_text(df)
    return flat.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in flat.columns])


def read_output_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """An output table by name; only known names are accepted."""
    if table not in fixed.OUTPUT_TABLES:
        raise ValueError(f"unknown output table {table}")
    return read_table(spark, f"{root.rstrip('/')}/{table}")


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each non-empty table as CSV with a header; returns title to folder.

    The folder of a table holds part files, so that no table passes through a
    single task.
    """
    written = {}
    for table, df in tables.items():
        if table not in fixed.OUTPUT_TABLES:
            raise ValueError(f"unknown output table {table}")
        if df.isEmpty():
            continue
        title = fixed.OUTPUT_TABLES[table]
        target = f"{out_dir.rstrip('/')}/{title.replace(' ', '_').lower()}.csv"
        flat_text(df).write.mode("overwrite").options(**_CSV).option("emptyValue", '""').csv(target)
        written[title] = target
    return written


def read_csv_mirror(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A mirrored table as text columns; multi-line cells are kept whole."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.read.schema(schema).options(**_CSV).option("multiLine", True).option("emptyValue", "").csv(path)
    )
