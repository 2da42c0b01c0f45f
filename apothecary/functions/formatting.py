"""Numbers as text for display tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: numbers are shown with seven significant digits.
SIGNIFICANT_DIGITS = 7
PENCE_DIGITS = 2


def decimals_shown(x: Column) -> Column:
    """Decimals a two-place amount needs to show seven significant digits."""
    size = F.abs(x)
    tenths, hundredths = F.bround(x, 1), F.bround(x, 2)
    one = F.when(tenths % 1 == 0, 0).otherwise(1)
    two = F.when((hundredths * 10) % 1 == 0, one).otherwise(2)
    limit = 10 ** (SIGNIFICANT_DIGITS - PENCE_DIGITS)
    return F.when(size < limit, two).when(size < 10 * limit, one).otherwise(0)


def thousands(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``columns`` as text with thousands separators, under new names.

    Whole numbers have no decimals. Amounts have as many, up to two, as any row
    of the column needs.
    """
    out: list[Column] = []
    for f in df.schema.fields:
        if f.name not in columns:
            out.append(F.col(f.name))
            continue
        x = F.col(f.name)
        if isinstance(f.dataType, (T.LongType, T.IntegerType)):
            text = F.format_number(x, 0)
        else:
            amount = x.cast("decimal(28,2)")
            # An aggregate of its own, as a scalar subquery: no task sees all rows.
            shown = df.agg(F.max(decimals_shown(amount))).scalar()
            value = amount.cast("double")
            text = (
                F.when(shown == 0, F.format_number(value, 0))
                .when(shown == 1, F.format_number(value, 1))
                .otherwise(F.format_number(value, 2))
            )
        out.append(text.alias(columns[f.name]))
    return df.select(*out)
