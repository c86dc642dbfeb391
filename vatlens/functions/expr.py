"""Column-expression helpers. All of them are built-in Spark expressions, so
they stay inside whole-stage code generation (no Python on the data path)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col_(c).cast("double")


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL (Spark 3 non-ANSI meaning)."""
    return F.try_divide(dbl(num), dbl(den))


def clamp_min(c: str | Column, lo=0) -> Column:
    """``case when c < lo then lo else c end`` -- NULL stays NULL."""
    c = col_(c)
    return F.when(c < F.lit(lo), F.lit(lo)).otherwise(c)


def least_of(a: str | Column, b: str | Column) -> Column:
    """``case when a <= b then a else b end``: NULL on either side picks ``b``."""
    a, b = col_(a), col_(b)
    return F.when(a <= b, a).otherwise(b)


def nz(c: str | Column, zero=0) -> Column:
    return F.coalesce(col_(c), F.lit(zero))


def product_abs_one_minus(c: str | Column) -> Column:
    """Aggregate: prod |1 - x| over the group, skipping factors equal to 0
    (NULL when every factor is skipped), computed as exp(sum(ln(.)))."""
    return F.exp(F.sum(F.ln(F.nullif(F.abs(F.lit(1) - col_(c)), F.lit(0)))))


def prior_period(period: str | Column) -> Column:
    """YYYYMM integer minus one month, January wraps to December of the year before."""
    p = col_(period).cast("int")
    return F.when(p % 100 == 1, (F.floor(p / 100) - 1) * 100 + 12).otherwise(p - 1).cast("int")


def prior_period_int(period: int) -> int:
    return (period // 100 - 1) * 100 + 12 if period % 100 == 1 else period - 1


def money_text(c: str | Column) -> Column:
    """``$1,234`` with no decimals; NULL becomes the empty string."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(dbl(c), 0)), F.lit(""))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (report outputs)."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])
