"""2.8 Lookup views behind the dashboard, as DataFrame filters and joins.

The reference pulled three whole tables to one machine and filtered them in
pandas per keystroke; here a lookup is a pushed-down filter on each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vatlens.functions.expr import money_text, safe_div


def normalise_id(text: str) -> str:
    return text.replace(" ", "")


def lookup_taxpayer(t360: DataFrame, tflow: DataFrame, cflow: DataFrame, id_text: str,
                    id_col: str = "id", group_col: str = "community") -> DataFrame:
    """The 360 row of one taxpayer beside its flow row and its community row (empty if unknown)."""
    row, flow, com = lookup_frames(t360, tflow, cflow, id_text, id_col, group_col)
    out = row.join(flow.withColumnRenamed("taxpayer", "_tp"), F.col(id_col) == F.col("_tp"), "left").drop("_tp")
    return out.join(com.withColumnRenamed("com", "_com"), F.col(group_col) == F.col("_com"), "left").drop("_com")


def lookup_frames(t360: DataFrame, tflow: DataFrame, cflow: DataFrame, id_text: str,
                  id_col: str = "id", group_col: str = "community") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The 360 row of one taxpayer, its flow row, and its community's row (each empty if unknown)."""
    key = normalise_id(id_text)
    # the literal takes the key's type, so that the filter reaches the scan; text that is no id finds nothing
    row = t360.where(F.col(id_col) == F.lit(key).try_cast(t360.schema[id_col].dataType))
    flow = tflow.where(F.col("taxpayer") == F.lit(key).try_cast(tflow.schema["taxpayer"].dataType))
    return row, flow, cflow.join(row.select(F.col(group_col).alias("com")), "com", "left_semi")


def number_text(c: str, digits: int = 4) -> F.Column:
    """A ratio with ``digits`` decimals; NULL stays NULL."""
    return F.format_number(F.col(c).cast("double"), digits)


def format_money(df: DataFrame, columns: list[str]) -> DataFrame:
    """``$1,234`` text for the money columns, '' for NULL."""
    return df.select([money_text(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def unpivot_row(df: DataFrame, columns: list[str] | None = None,
                attribute: str = "attribute", value: str = "value") -> DataFrame:
    """Row(s) -> (attribute, value) pairs; values are cast to text first."""
    cols = columns or df.columns
    text = df.select([F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot([], cols, attribute, value)


def intra_extra_share(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """For each (intra, extra) pair: % intra and % extra of their sum (NULL if the sum is 0)."""
    out = [F.col(c) for c in df.columns]
    for name, (intra, extra) in pairs.items():
        total = F.col(intra) + F.col(extra)
        out.append((safe_div(intra, total) * 100).alias(f"pct_intra_{name}"))
        out.append((safe_div(extra, total) * 100).alias(f"pct_extra_{name}"))
    return df.select(out)
