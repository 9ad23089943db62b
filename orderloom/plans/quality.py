"""Data-quality checks. Each returns verdict rows: table, column, check, number of failures.

Counting follows the usual meaning of the checks: ``unique`` counts repeated values, ``not_null``
rows, ``accepted_values`` distinct foreign values, ``accepted_range`` and ``relationships`` rows.
NULL fails ``not_null`` only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]

# The declared checks.
UNIQUE = (
    ("olist_orders", "order_id"),
    ("olist_customers", "customer_id"),
    ("stg_orders", "order_line_id"),
    ("stg_customers", "customer_id"),
    ("stg_products", "product_id"),
    ("stg_sellers", "seller_id"),
    ("dim_customer", "customer_id"),
    ("dim_product", "product_id"),
    ("dim_seller", "seller_id"),
    ("dim_payment_type", "payment_type"),
    ("dim_date", "date_key"),
    ("fct_orders", "order_line_id"),
)
NOT_NULL = {
    "olist_orders": ("order_id",),
    "olist_customers": ("customer_id",),
    "stg_orders": ("order_line_id", "order_id", "customer_id", "order_date"),
    "stg_customers": ("customer_id", "customer_unique_id"),
    "stg_products": ("product_id",),
    "stg_sellers": ("seller_id",),
    "stg_payments": ("order_id", "payment_type", "payment_value"),
    "stg_reviews": ("review_id", "order_id", "review_score"),
    "dim_customer": ("customer_id", "customer_unique_id"),
    "dim_product": ("product_id",),
    "dim_seller": ("seller_id",),
    "dim_payment_type": ("payment_type",),
    "dim_date": ("date_key",),
    "fct_orders": (
        "order_line_id",
        "order_id",
        "customer_id",
        "product_id",
        "seller_id",
        "payment_type",
        "date_key",
        "item_price",
        "freight_value",
        "gross_item_amount",
    ),
    "fct_daily_sales": ("date_key", "seller_id"),
}
RELATIONSHIPS = (
    ("fct_orders", "customer_id", "dim_customer", "customer_id"),
    ("fct_orders", "product_id", "dim_product", "product_id"),
    ("fct_orders", "seller_id", "dim_seller", "seller_id"),
    ("fct_orders", "payment_type", "dim_payment_type", "payment_type"),
    ("fct_orders", "date_key", "dim_date", "date_key"),
)
ACCEPTED_VALUES = {
    "stg_payments": {
        "payment_type": ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
    },
}
ACCEPTED_RANGES = {
    "stg_products": {"product_weight_g": (0, None)},
    "stg_payments": {"payment_value": (0, None)},
    "stg_reviews": {"review_score": (1, 5)},
    "dim_product": {"product_weight_g": (0, None)},
    "fct_orders": {"item_price": (0, None), "freight_value": (0, None)},
    "fct_daily_sales": {"gross_sales": (0, None)},
}
UNIQUE_COMBINATIONS = (("fct_daily_sales", ("date_key", "seller_id")),)
SALES_TOLERANCE = 0.01
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 72

# A row-level check: column, check, SQL aggregate that counts its failures.
Measure = tuple[str, str, str]


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def null_measures(columns: Iterable[str]) -> list[Measure]:
    return [(name, "not_null", f"count_if({name} is null)") for name in columns]


def value_measures(accepted: dict[str, Sequence]) -> list[Measure]:
    measures = []
    for name, values in accepted.items():
        listed = ", ".join(_literal(value) for value in values)
        foreign = f"count(distinct case when {name} not in ({listed}) then {name} end)"
        measures.append((name, "accepted_values", foreign))
    return measures


def outside(column: str, low=None, high=None, inclusive: bool = True) -> str:
    """SQL: the value lies outside its bounds, both optional; not true where it is NULL."""
    below, above = ("<", ">") if inclusive else ("<=", ">=")
    limits = [(below, low), (above, high)]
    broken = [f"{column} {sign} {bound}" for sign, bound in limits if bound is not None]
    return " or ".join(broken) or "false"


def range_measures(ranges: dict[str, tuple]) -> list[Measure]:
    return [
        (name, "accepted_range", f"count_if({outside(name, *bounds)})")
        for name, bounds in ranges.items()
    ]


#: The row-level checks.
ROW_LEVEL = ("not_null", "accepted_values", "accepted_range")


def row_measures(table: str, checks: Iterable[str] = ROW_LEVEL) -> list[Measure]:
    """The declared row-level checks of a table."""
    measures = null_measures(NOT_NULL.get(table, ()))
    measures += value_measures(ACCEPTED_VALUES.get(table, {}))
    measures += range_measures(ACCEPTED_RANGES.get(table, {}))
    return [measure for measure in measures if measure[1] in checks]


#: Totals that are compared between the facts, and the aggregates that give them. Money is summed as
#: decimals: in doubles, from some amount of turnover on, the order of addition alone moves the total
#: by more than any tolerance worth having.
TOTALS = {
    "fct_orders": {"lines": "count(*)", "sales": "sum(cast(gross_item_amount as decimal(38, 6)))"},
    "fct_daily_sales": {"lines": "sum(line_count)", "sales": "sum(cast(gross_sales as decimal(38, 6)))"},
}

#: What was measured of tables while they were written: values by name for each table.
Observed = dict[str, dict]


def metrics(
    table: str, checks: Iterable[str] = ROW_LEVEL, totals: Iterable[str] = ("lines", "sales")
) -> list[Column]:
    """Aggregates to observe on the write that makes a table, so that its checks need no second look
    at its rows: the row-level checks, but those that count distinct values, and the totals.

    Observe them on the write itself: there each row is counted once even if a task is run again,
    which below a shuffle it would not be.
    """
    measures = [m for m in row_measures(table, checks) if "distinct" not in m[2]]
    named = {f"{check} {column}": failures for column, check, failures in measures}
    named |= {f"total {k}": v for k, v in TOTALS.get(table, {}).items() if k in totals}
    return [F.expr(sql).alias(name) for name, sql in named.items()]


def _local(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Verdict rows known already."""
    schema = "table_name string, column_name string, check_name string, failures bigint"
    return df.sparkSession.createDataFrame(rows, schema)


def observed_rows(table: str, observed: dict, checks: Iterable[str] = ROW_LEVEL) -> list[tuple]:
    """Verdicts of the row-level checks that were observed."""
    return [
        (table, column, check, observed[f"{check} {column}"])
        for column, check, _ in row_measures(table, checks)
        if f"{check} {column}" in observed
    ]


def _verdict(table: str, column: str, check: str, failures: str) -> str:
    return (
        f"struct('{table}' as table_name, '{column}' as column_name, '{check}' as check_name, "
        f"cast({failures} as bigint) as failures)"
    )


def _verdicts(df: DataFrame, verdicts: Sequence[str]) -> DataFrame:
    """One global aggregate over ``df``, one output row per verdict."""
    return df.selectExpr(f"array({', '.join(verdicts)}) as verdicts").selectExpr("inline(verdicts)")


def row_verdicts(df: DataFrame, table: str, measures: Sequence[Measure]) -> DataFrame:
    """Any number of row-level checks of a table in one aggregate, turned into one row each."""
    return _verdicts(df, [_verdict(table, *measure) for measure in measures])


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def unique(keys: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Values that occur more than once, NULL aside, for several (table, column, rows) at once.

    All keys share one shuffle, after counting within each task.
    """
    values = union(
        rows.where(f"{column} is not null").selectExpr(
            f"{number} as number", f"cast({column} as string) as value"
        )
        for number, (_, column, rows) in enumerate(keys)
    )
    repeated = values.groupBy("number", "value").agg(F.expr("count(*) as n")).where("n > 1")
    return _verdicts(
        repeated,
        [
            _verdict(table, column, "unique", f"count_if(number = {number})")
            for number, (table, column, _) in enumerate(keys)
        ],
    )


def unique_combination(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Combinations of values that occur more than once; NULL compares like a value."""
    groups = df.groupBy(*columns).agg(F.expr("count(*) as n"))
    verdict = _verdict(table, ",".join(columns), "unique_combination", "count_if(n > 1)")
    return _verdicts(groups, [verdict])


def relationships(
    child: DataFrame, table: str, parents: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Child rows whose key is missing in its parent, for several (child column, parent, parent
    column) at once.

    The child is read once: its keys are turned into (column, value) pairs and counted before the
    shuffle, so a key shared by very many rows travels as one.
    """
    pairs = ", ".join(
        f"struct({number} as number, cast({column} as string) as value)"
        for number, (column, _, _) in enumerate(parents)
    )
    used = (
        child.selectExpr(f"inline(array({pairs}))")
        .where("value is not null")
        .groupBy("number", "value")
        .agg(F.expr("count(*) as n"))
    )
    known = union(
        parent.selectExpr(f"{number} as number", f"cast({field} as string) as value")
        for number, (_, parent, field) in enumerate(parents)
    )
    orphans = used.join(known, ["number", "value"], "left_anti")
    return _verdicts(
        orphans,
        [
            _verdict(
                table,
                column,
                "relationships",
                f"coalesce(sum(n) filter (where number = {number}), 0)",
            )
            for number, (column, _, _) in enumerate(parents)
        ],
    )


def _totals(daily: DataFrame, daily_total: str, lines: DataFrame, line_total: str) -> DataFrame:
    """Two one-row totals side by side, through a union instead of a cross join."""
    both = daily.selectExpr(f"{daily_total} as daily", "null as lines").unionAll(
        lines.selectExpr("null as daily", f"{line_total} as lines")
    )
    return both.selectExpr("max(daily) as daily", "max(lines) as lines")


def line_count_matches(daily_sales: DataFrame, orders: DataFrame) -> DataFrame:
    """1 if the daily lines do not add up to the order lines."""
    totals = _totals(daily_sales, "sum(line_count)", orders, "count(*)")
    failed = "count_if(daily != lines)"
    return _verdicts(
        totals, [_verdict("fct_daily_sales", "line_count", "line_count_matches", failed)]
    )


def sales_totals(daily_sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Gross sales by the daily fact and by the order lines, and their difference, see TOTALS."""
    totals = _totals(
        daily_sales, TOTALS["fct_daily_sales"]["sales"], orders, TOTALS["fct_orders"]["sales"]
    )
    return totals.selectExpr(
        "daily as daily_total", "lines as line_total", "daily - lines as difference"
    )


def sales_reconcile(
    daily_sales: DataFrame, orders: DataFrame, tolerance: float = SALES_TOLERANCE
) -> DataFrame:
    """1 if the daily gross sales differ from the order lines' by more than the tolerance."""
    failed = f"count_if(abs(difference) > {tolerance})"
    return _verdicts(
        sales_totals(daily_sales, orders),
        [_verdict("fct_daily_sales", "gross_sales", "sales_reconcile", failed)],
    )


def observed_reconciliations(observed: Observed, tolerance: float = SALES_TOLERANCE) -> list[tuple]:
    """Verdicts of ``line_count_matches`` and ``sales_reconcile`` from totals that were observed."""
    daily, lines = observed["fct_daily_sales"], observed["fct_orders"]
    out = []
    for total, column, check, most in (
        ("lines", "line_count", "line_count_matches", 0),
        ("sales", "gross_sales", "sales_reconcile", tolerance),
    ):
        a, b = daily.get(f"total {total}"), lines.get(f"total {total}")
        if f"total {total}" in daily:  # an empty table has no sum, which differs from nothing
            failed = a is not None and b is not None and abs(a - b) > Decimal(str(most))
            out.append(("fct_daily_sales", column, check, int(failed)))
    return out


def lines_outside_calendar(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Order lines dated before the first or after the last calendar day."""
    first = calendar.selectExpr("min(date_key)").scalar()
    last = calendar.selectExpr("max(date_key)").scalar()
    day = F.col("date_key")
    return orders.where((day < first) | (day > last)).select("order_line_id", "date_key")


def within_calendar(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    outside_lines = lines_outside_calendar(orders, calendar)
    return _verdicts(
        outside_lines, [_verdict("fct_orders", "date_key", "within_calendar", "count(*)")]
    )


def unique_suite(tables: Tables) -> DataFrame:
    return unique([(table, column, tables[table]) for table, column in UNIQUE])


def not_null_suite(tables: Tables) -> DataFrame:
    return union(
        row_verdicts(tables[table], table, null_measures(columns))
        for table, columns in NOT_NULL.items()
    )


def accepted_values_suite(tables: Tables) -> DataFrame:
    return union(
        row_verdicts(tables[table], table, value_measures(accepted))
        for table, accepted in ACCEPTED_VALUES.items()
    )


def accepted_range_suite(tables: Tables) -> DataFrame:
    return union(
        row_verdicts(tables[table], table, range_measures(ranges))
        for table, ranges in ACCEPTED_RANGES.items()
    )


def unique_combination_suite(tables: Tables) -> DataFrame:
    return union(
        unique_combination(tables[table], table, columns)
        for table, columns in UNIQUE_COMBINATIONS
    )


def relationships_suite(tables: Tables) -> DataFrame:
    children = dict.fromkeys(child for child, _, _, _ in RELATIONSHIPS)
    return union(
        relationships(
            tables[child],
            child,
            [
                (column, tables[parent], field)
                for owner, column, parent, field in RELATIONSHIPS
                if owner == child
            ],
        )
        for child in children
    )


def row_level_suite(tables: Tables, observed: Observed | None = None) -> DataFrame:
    """All row-level checks of the given tables, one aggregate per table for those that were not
    observed while the table was written."""
    known, verdicts = [], []
    for table in NOT_NULL:
        if table in tables:
            seen = (observed or {}).get(table, {})
            known += observed_rows(table, seen)
            rest = [m for m in row_measures(table) if f"{m[1]} {m[0]}" not in seen]
            if rest:
                verdicts.append(row_verdicts(tables[table], table, rest))
    if known:
        verdicts.append(_local(next(iter(tables.values())), known))
    return union(verdicts)


def with_status(verdicts: DataFrame) -> DataFrame:
    return verdicts.selectExpr("*", "if(failures = 0, 'pass', 'fail') as status")


def input_suite(tables: Tables) -> DataFrame:
    """What can be checked before the gold tables exist: row-level and uniqueness checks of the raw
    and staging tables given."""
    keys = [(table, column, tables[table]) for table, column in UNIQUE if table in tables]
    return with_status(union([row_level_suite(tables), unique(keys)]))


def check_suite(tables: Tables, observed: Observed | None = None) -> DataFrame:
    """All declared checks and the three reconciliations, one verdict row each.

    Meant for written gold tables: each part then reads only its columns. What was observed while
    they were written is not looked up again; the row-level checks left share one aggregate a table.
    """
    daily, orders = tables["fct_daily_sales"], tables["fct_orders"]
    if observed and {"fct_daily_sales", "fct_orders"} <= set(observed):
        totals = [_local(daily, observed_reconciliations(observed))]
    else:
        totals = [line_count_matches(daily, orders), sales_reconcile(daily, orders)]
    return with_status(
        union(
            [
                row_level_suite(tables, observed),
                unique_suite(tables),
                unique_combination_suite(tables),
                relationships_suite(tables),
                *totals,
                within_calendar(orders, tables["dim_date"]),
            ]
        )
    )


def _values(df: DataFrame, table: str, column: str, check: str, value: str, rows: str = "count(*)") -> DataFrame:
    """What fails a check: each value, as text, with its number of rows."""
    found = df.groupBy(F.expr(value).cast("string").alias("value")).agg(F.expr(f"{rows} as row_count"))
    return found.selectExpr(
        f"'{table}' as table_name", f"'{column}' as column_name", f"'{check}' as check_name",
        "value", "cast(row_count as bigint) as row_count",
    )


def failing_values(tables: Tables) -> DataFrame:
    """What fails the declared checks of the given tables, for whoever has to mend it: the value, as
    text, and in how many rows it stands. A missing value is NULL; a combination of columns is its
    parts joined by a comma. A check that passes has no row.

    Rows are counted by value within each task before they are shuffled, so a value that fails
    everywhere travels as one; what passes is filtered out at the scan.
    """
    parts = []
    for table, rows in tables.items():
        for column in NOT_NULL.get(table, ()):
            parts.append(_values(rows.where(f"{column} is null"), table, column, "not_null", column))
        for column, values in ACCEPTED_VALUES.get(table, {}).items():
            listed = ", ".join(_literal(value) for value in values)
            foreign = rows.where(f"{column} not in ({listed})")
            parts.append(_values(foreign, table, column, "accepted_values", column))
        for column, bounds in ACCEPTED_RANGES.get(table, {}).items():
            beyond = rows.where(outside(column, *bounds))
            parts.append(_values(beyond, table, column, "accepted_range", column))
    for table, column in UNIQUE:
        if table in tables:
            known = tables[table].where(f"{column} is not null")
            parts.append(_values(known, table, column, "unique", column).where("row_count > 1"))
    for table, columns in UNIQUE_COMBINATIONS:
        if table in tables:
            groups = tables[table].groupBy(*columns).agg(F.expr("count(*) as n")).where("n > 1")
            text = "concat_ws(',', " + ", ".join(f"coalesce(cast({c} as string), '')" for c in columns) + ")"
            parts.append(_values(groups, table, ",".join(columns), "unique_combination", text, "sum(n)"))
    for child, column, parent, field in RELATIONSHIPS:
        if child in tables and parent in tables:
            used = tables[child].where(f"{column} is not null").groupBy(column).agg(F.expr("count(*) as n"))
            known = tables[parent].select(F.col(field).alias(column))
            orphans = used.join(known, column, "left_anti")
            parts.append(_values(orphans, child, column, "relationships", column, "sum(n)"))
    return union(parts)


def load_stamps(tables: Tables) -> DataFrame:
    return union(
        df.selectExpr(f"'{name}' as table_name", "cast(_loaded_at as timestamp) as _loaded_at")
        for name, df in tables.items()
    )


def freshness(stamps: DataFrame, as_of: Column) -> DataFrame:
    """Age of the newest load per source at ``as_of``: over a day old warns, over three days is an
    error, as is a source that has no stamp at all. ``stamps`` has table_name and _loaded_at."""
    newest = stamps.groupBy("table_name").agg(F.expr("max(_loaded_at) as max_loaded_at"))
    aged = newest.withColumn("as_of", as_of.cast("timestamp")).selectExpr(
        "table_name", "max_loaded_at", "unix_micros(as_of) - unix_micros(max_loaded_at) as age"
    )
    hour = 3_600_000_000
    return aged.selectExpr(
        "table_name",
        "max_loaded_at",
        "cast(floor(age / 1000000) as bigint) as age_seconds",
        f"case when age is null or age > {ERROR_AFTER_HOURS * hour} then 'error' "
        f"when age > {WARN_AFTER_HOURS * hour} then 'warn' else 'pass' end as status",
    )
