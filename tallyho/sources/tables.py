"""Table scans (dashboard, source, date dimension) and the row filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows of this class are plan figures, never compared.
BUDGET = "Budget"
ROW_CLASS_COLUMN = "data_type"


def resolve(spark: SparkSession, table) -> DataFrame:
    """A DataFrame as-is, a parquet path, or a catalog table name."""
    if isinstance(table, DataFrame):
        return table
    name = str(table)
    if "/" in name or name.endswith(".parquet"):
        return spark.read.parquet(name)
    return spark.table(name)


def non_budget(df: DataFrame) -> Column | None:
    """``data_type != 'Budget' OR data_type IS NULL`` when the column exists."""
    # Names resolve as the session resolves them, without regard to case by default.
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    if ROW_CLASS_COLUMN not in (df.columns if exact else [c.lower() for c in df.columns]):
        return None
    c = F.col(ROW_CLASS_COLUMN)
    return (c != F.lit(BUDGET)) | c.isNull()


def row_filter(df: DataFrame, expr: str | None) -> Column | None:
    """The configured filter replaces the default non-budget filter."""
    if expr:
        return F.expr(expr)
    return non_budget(df)


def keep(df: DataFrame, expr: str | None) -> DataFrame:
    cond = row_filter(df, expr)
    return df if cond is None else df.where(cond)


def testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
