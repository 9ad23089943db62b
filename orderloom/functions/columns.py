"""Column expressions shared by the models. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_line_id(order_id: str, item_id: str) -> Column:
    """``<order>-<item>``. A NULL part counts as empty text instead of making the key NULL."""
    return F.expr(
        f"coalesce(cast({order_id} as string), '') || '-' || coalesce(cast({item_id} as string), '')"
    )


def whole(df: DataFrame, column: str) -> Column:
    """A column as int. Text may be a decimal number and is rounded, halves away from zero; doubles
    are rounded, halves to even. Empty text is NULL. Text that is no number and numbers that do not
    fit stop the query, whether or not the session is in ANSI mode."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int"):
        return F.expr(f"cast({column} as int)")
    text = f"nullif(trim(cast({column} as string)), '')"
    number = f"round(try_cast({text} as decimal(38, 10)), 0)"
    if kind in ("float", "double"):
        number = f"rint({column})"
    wrong = f"raise_error(concat('not a whole number for {column}: ', {text}))"
    return F.expr(
        f"case when {text} is null then cast(null as int) "
        f"when coalesce(abs({number}) <= 2147483647, false) then cast({number} as int) "
        f"else cast({wrong} as int) end"
    )


def is_weekend(day: str) -> Column:
    """Saturday or Sunday; ``dayofweek`` counts Sunday as 1 and Saturday as 7."""
    return F.expr(f"coalesce(dayofweek({day}) in (1, 7), false)")


def payment_label(payment_type: str) -> Column:
    return F.expr(f"replace({payment_type}, '_', ' ')")


def top_type(value: str, name: str) -> Column:
    """Aggregate: the name with the largest value, ties to the smallest name, NULLs last in both.

    The struct sorts ascending: the flags push NULLs back and NaN, the largest double, forward, and
    the minus sign turns the value order round. As an aggregate it combines before the shuffle,
    which a window would not.
    """
    return F.expr(
        f"min(struct({value} is null as no_value, not isnan({value}) as is_number, "
        f"-{value} as negated, {name} is null as no_name, {name} as name)).name"
    )
