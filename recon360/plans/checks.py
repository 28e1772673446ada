"""Validation of a finished run as a table (check_name, observed, expected, passed).

Every check adds up measures from one or more tables, so each table is aggregated where it lies and
only one row per measure moves on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recon360.functions.text import is_country_variant, is_full_state_name
from recon360.model import CURATED_COLUMNS
from recon360.operators import dedup, predicates
from recon360.operators.references import dangling
from recon360.plans.conform import Customer360

KEYS = {name: columns[0] for name, columns in CURATED_COLUMNS.items() if name != "dq_exception_report"}


def _where(condition: str | Column) -> Column:
    return F.count_if(F.expr(condition) if isinstance(condition, str) else condition)


def _measure(df: DataFrame, **values: Column) -> DataFrame:
    """One row per named aggregate: ``<check>__observed`` or ``<check>__expected``."""
    row = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in values)
    return row.selectExpr(f"stack({len(values)}, {pairs}) as (name, value)")


def _checks(*measures: DataFrame, at_least: tuple[str, ...] = (), above: tuple[str, ...] = ()) -> DataFrame:
    side = F.split("name", "__")
    rows = reduce(DataFrame.unionByName, measures).select(
        side[0].alias("check_name"), side[1].alias("side"), F.coalesce("value", F.lit(0.0)).alias("value")
    )

    def total(which: str) -> Column:
        return F.sum(F.when(F.col("side") == which, F.col("value")).otherwise(0.0))

    observed, expected, name = F.col("observed"), F.col("expected"), F.col("check_name")
    passed = (
        F.when(name.isin(list(at_least)), observed >= expected)
        .when(name.isin(list(above)), observed > expected)
        .otherwise(observed == expected)
    )
    return (
        rows.groupBy("check_name")
        .agg(total("observed").alias("observed"), total("expected").alias("expected"))
        .withColumn("passed", passed)
    )


def _count(name: str, df: DataFrame) -> DataFrame:
    return _measure(df, **{name: F.count(F.lit(1))})


def _reported(exceptions: DataFrame, **names: str) -> DataFrame:
    """How many records each of the rules reported, each counted once; ``names`` gives the measure of a rule."""
    rule = F.col("rule_id")
    name = reduce(lambda c, r: c.when(rule == r, names[r]), names, F).alias("name")
    records = exceptions.where(rule.isin(*names)).select("rule_id", "record_key").distinct()
    return records.groupBy(name).agg(F.count(F.lit(1)).cast("double").alias("value"))


def row_accounting(t: Customer360, exceptions: DataFrame) -> DataFrame:
    """Staging rows = curated rows + rows removed, and nothing removed or unresolved is unreported."""
    covered = "exceptions_cover_all__expected"
    measures = [_count(covered.replace("expected", "observed"), exceptions)]
    for name, table, key in [
        ("customers", t.dim_customer, "customer_id"),
        ("orders", t.fact_order, "order_id"),
        ("products", t.dim_product, None),
        ("payments", t.fact_payment, None),
        ("support_tickets", t.fact_customer_issue, None),
    ]:
        raw = getattr(t.staging, name)
        measures += [_count(f"{name}_rows__observed", raw), _count(f"{name}_rows__expected", table)]
        if key:
            surplus = dedup.duplicate_ids(raw, key)
            measures.append(
                _measure(
                    surplus,
                    **{f"{name}_rows__expected": F.sum(F.col("n_rows") - 1), covered: F.count(F.lit(1))},
                )
            )
    merged = F.count(F.lit(1))
    measures += [
        _measure(t.id_crosswalk, **{"customers_rows__expected": merged, covered: merged}),
        _measure(t.fact_order, **{covered: _where("customer_key is null") + _where("product_key is null")}),
        _measure(t.fact_payment, **{covered: _where("order_key is null")}),
        _measure(t.fact_customer_issue, **{covered: _where("customer_key is null")}),
    ]
    return _checks(*measures, at_least=("exceptions_cover_all",))


def referential(t: Customer360, exceptions: DataFrame) -> DataFrame:
    """Keys that are set have a parent, and keys that are not set were reported."""
    links = [
        ("order_customer", t.fact_order, "customer_key", t.dim_customer, "customer_key", "DQ005"),
        ("order_product", t.fact_order, "product_key", t.dim_product, "product_key", "DQ006"),
        ("payment_order", t.fact_payment, "order_key", t.fact_order, "order_key", "DQ009"),
        ("ticket_customer", t.fact_customer_issue, "customer_key", t.dim_customer, "customer_key", "DQ012"),
    ]
    measures = []
    for name, fact, key, parent, parent_key, rule in links:
        measures += [
            _count(f"{name}_dangling__observed", dangling(fact.select(key), key, parent.select(parent_key), parent_key)),
            _measure(fact, **{f"{name}_unresolved__observed": _where(F.col(key).isNull())}),
        ]
    return _checks(*measures, _reported(exceptions, **{rule: f"{name}_unresolved__expected" for name, *_, rule in links}))


def amounts(t: Customer360, exceptions: DataFrame) -> DataFrame:
    revenue = F.sum(F.when(predicates.completed(), F.col("gross_order_amount")))
    unreadable = _where(predicates.completed() & F.col("quantity").isNull())
    mismatched = t.order_payments.where(predicates.completed() & predicates.payment_mismatch())
    return _checks(
        _measure(
            t.fact_order,
            completed_revenue_positive__observed=revenue,
            non_positive_quantity__observed=_where(predicates.suspicious_quantity()) + unreadable,
            total_mismatch__observed=_where(predicates.total_mismatch()),
        ),
        _measure(
            t.dim_product,
            active_price_not_positive__observed=_where("active_flag = 1 and (unit_price is null or unit_price <= 0)"),
        ),
        _count("settled_mismatch__observed", mismatched),
        _reported(
            exceptions,
            DQ007="non_positive_quantity__expected",
            DQ008="total_mismatch__expected",
            DQ010="settled_mismatch__expected",
        ),
        above=("completed_revenue_positive",),
    )


def parsing(t: Customer360, exceptions: DataFrame) -> DataFrame:
    measures = [
        _measure(df, **{f"{name}_key_missing__observed": _where(F.col(KEYS[name]).isNull())})
        for name, df in t.curated().items()
    ]
    blank = F.col("created_ts").isNull() | (F.trim("created_ts") == "")
    return _checks(
        *measures,
        _measure(t.fact_order, order_date_missing__observed=_where("order_date is null")),
        _measure(t.fact_customer_issue, ticket_date_missing__observed=_where("created_date is null")),
        _reported(exceptions, DQ011="ticket_date_missing__expected"),
        _measure(t.staging.support_tickets, ticket_date_missing__expected=_where(blank)),
        _measure(t.dim_product, unit_price_missing__observed=_where("unit_price is null")),
        _measure(
            t.dim_customer,
            country_variant_left__observed=_where(is_country_variant(F.col("standard_country"))),
            state_name_left__observed=_where(is_full_state_name(F.col("standard_state"))),
        ),
    )


def all_checks(t: Customer360, exceptions: DataFrame) -> DataFrame:
    parts = [check(t, exceptions) for check in (row_accounting, referential, amounts, parsing)]
    return reduce(DataFrame.unionByName, [*parts, key_unique(t)])


def key_unique(t: Customer360) -> DataFrame:
    return _checks(
        *[_count(f"{name}_key_repeated__observed", dedup.duplicate_keys(df, KEYS[name])) for name, df in t.curated().items()],
        _count("id_crosswalk_key_repeated__observed", dedup.duplicate_keys(t.id_crosswalk, "old_customer_id")),
    )


def require_unique_keys(t: Customer360) -> None:
    """Fail the run where a target key repeats, as sources must not repeat these ids."""
    broken = [row["check_name"] for row in key_unique(t).where("not passed").collect()]
    if broken:
        raise ValueError(f"repeated keys: {sorted(broken)}")
