"""How queries and their SQL come to equal columns: bigint for whole numbers, rounded doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 7


def even(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Whole numbers as bigint; doubles rounded, without a negative zero."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def even_sql(body: str, whole: str = "", doubles: str = "", other: str = "", digits: int = DIGITS) -> str:
    """SELECT of body (a query, after WITH clauses if any) with the same rules."""
    head, _, tail = body.rpartition("--\n")
    columns = [f"CAST({c} AS BIGINT) AS {c}" for c in whole.split()]
    columns += [f"round(CAST({c} AS DOUBLE), {digits}) + 0e0 AS {c}" for c in doubles.split()]
    columns += other.split()
    return f"{head}SELECT {', '.join(columns)} FROM ({tail}) AS q"
