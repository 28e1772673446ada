"""Data-quality rules: conditions over a few sources, all of a source's rules found in one scan.

A rule is a condition on a row of its source and a text; the rules of one source become one array of
findings per row, unpacked in the same scan. Severity, advice and order come from the catalog, which is
a table of its own and is joined to the findings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.functions.messages import message, shown, shown_amount
from recon360.functions.text import is_country_variant, is_full_state_name, strip
from recon360.model import EXCEPTION_COLUMNS, SEQ, Rule
from recon360.operators import predicates
from recon360.plans.conform import Customer360, Store
from recon360.sources.store import constant_rows


@dataclass(frozen=True)
class Finding:
    """What a rule looks for in the rows of a source. Conditions and texts are made when asked for, as
    columns need a running session."""

    rule_id: str
    source: str
    key: str
    template: str
    when: Callable[[], Column]
    values: Callable[[], dict[str, Column]] = dict

    def column(self) -> Column:
        """The finding as a struct, NULL for a row without it."""
        text = message(self.template, key=shown(F.col(self.key)), **self.values())
        found = F.struct(
            F.lit(self.rule_id).alias("rule_id"), F.col(self.key).alias("record_key"), text.alias("issue_description")
        )
        return F.when(self.when(), found)


# --- sources: one row per thing that rules look at


def _customer_ids(t: Customer360) -> DataFrame:
    """Per raw customer id the number of its rows, and of the odd countries and states the earliest."""

    def earliest(odd: Column, c: str) -> Column:
        return F.min(F.when(odd, F.struct(SEQ, strip(F.col(c)).alias("value"))))["value"]

    return t.staging.customers.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        earliest(is_country_variant(F.col("country")), "country").alias("odd_country"),
        earliest(is_full_state_name(F.col("state")), "state").alias("odd_state"),
    )


def _order_ids(t: Customer360) -> DataFrame:
    return t.staging.orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"))


def _orders(t: Customer360) -> DataFrame:
    """Orders with ``retired``, set where their product is not sold any more."""
    retired = t.dim_product.where("active_flag = 0").select("product_key", F.lit(True).alias("retired"))
    return t.fact_order.join(retired, "product_key", "left")


SOURCES: dict[str, Callable[[Customer360], DataFrame]] = {
    "customer_ids": _customer_ids,
    "customers": lambda t: t.dim_customer.select("customer_key", "email"),
    "merged": lambda t: t.id_crosswalk,
    "order_ids": _order_ids,
    "orders": _orders,
    "lost_orders": lambda t: t.order_trace,
    "paid_orders": lambda t: t.order_payments,
    "lost_payments": lambda t: t.payment_trace,
    "lost_tickets": lambda t: t.ticket_trace,
}


def _amounts(*names: str) -> dict[str, Column]:
    return {name: shown_amount(F.col(name)) for name in names}


def _settled_gap() -> Column:
    """Only settled payments of completed orders."""
    gap = F.col("payment_amount") - F.col("gross_order_amount")
    return predicates.completed() & predicates.settled() & predicates.differs(gap)


# The texts of the findings.
FINDINGS = [
    Finding(
        "DQ001", "customer_ids", "customer_id",
        "customer_id {key} appears {n} times in source (exact duplicate rows)",
        lambda: F.col("n_rows") > 1, lambda: {"n": shown(F.col("n_rows"))},
    ),
    Finding(
        "DQ002", "customers", "customer_key", "Customer {key} has no email address on record", lambda: F.col("email").isNull()
    ),
    # at most one finding per id and field, worded after the earliest row
    Finding(
        "DQ003", "customer_ids", "customer_id",
        "Customer {key} country '{value}' is a non-standard variant; should be 'USA'",
        lambda: F.col("odd_country").isNotNull(), lambda: {"value": F.col("odd_country")},
    ),
    Finding(
        "DQ003", "customer_ids", "customer_id",
        "Customer {key} state '{value}' is a full name; should use two-letter code",
        lambda: F.col("odd_state").isNotNull(), lambda: {"value": F.col("odd_state")},
    ),
    Finding(
        "DQ004", "order_ids", "order_id",
        "order_id {key} appears {n} times in source (exact duplicate rows)",
        lambda: F.col("n_rows") > 1, lambda: {"n": shown(F.col("n_rows"))},
    ),
    Finding(
        "DQ005", "lost_orders", "order_key",
        "Order {key} references non-existent customer_id '{raw}'",
        lambda: F.col("no_customer"), lambda: {"raw": shown(F.col("customer_id"))},
    ),
    Finding(
        "DQ006", "lost_orders", "order_key",
        "Order {key} references non-existent product_id '{raw}'",
        lambda: F.col("no_product"), lambda: {"raw": shown(F.col("product_id"))},
    ),
    # unlike the answers, this rule also counts an unreadable quantity
    Finding(
        "DQ007", "orders", "order_key",
        "Completed order {key} has non-positive quantity {quantity} (gross total: {gross_order_amount})",
        lambda: predicates.completed() & F.expr("quantity is null or quantity <= 0"),
        lambda: {"quantity": shown(F.col("quantity")), **_amounts("gross_order_amount")},
    ),
    Finding(
        "DQ008", "orders", "order_key",
        "Order {key} stated total {gross_order_amount} does not match computed {calculated_order_amount} "
        "(variance: {order_amount_variance})",
        predicates.total_mismatch,
        lambda: _amounts("gross_order_amount", "calculated_order_amount", "order_amount_variance"),
    ),
    Finding(
        "DQ009", "lost_payments", "payment_key",
        "Payment {key} references non-existent order_id '{raw}'",
        lambda: F.lit(True), lambda: {"raw": shown(F.col("order_id"))},
    ),
    Finding(
        "DQ010", "paid_orders", "payment_key",
        "Payment {key} settled amount {payment_amount} does not match completed order {order} total {gross_order_amount}",
        _settled_gap, lambda: {"order": F.col("order_key"), **_amounts("payment_amount", "gross_order_amount")},
    ),
    Finding(
        "DQ011", "lost_tickets", "ticket_key",
        "Ticket {key} has unparseable created_ts: '{raw}'",
        lambda: F.col("no_date") & (F.trim("created_ts") != ""), lambda: {"raw": F.col("created_ts")},
    ),
    Finding(
        "DQ012", "lost_tickets", "ticket_key",
        "Ticket {key} references non-existent customer_id '{raw}'",
        lambda: F.col("no_customer"), lambda: {"raw": shown(F.col("customer_id"))},
    ),
    Finding(
        "DQ013", "merged", "old_customer_id",
        "customer_id {key} resolves to the same person as canonical customer {root} (matching full_name + phone or email)",
        lambda: F.lit(True), lambda: {"root": F.col("canonical_customer_id")},
    ),
    Finding(
        "DQ014", "orders", "order_key",
        "Order {key} references inactive product {product} (active_flag = 0)",
        lambda: F.col("retired"), lambda: {"product": F.col("product_key")},
    ),
]
RULES = frozenset(f.rule_id for f in FINDINGS)


def findings(t: Customer360, rule_ids: set[str]) -> DataFrame:
    """(rule_id, record_key, issue_description) of the named rules: each source is scanned once."""
    parts = []
    for source, rows in SOURCES.items():
        wanted = [f for f in FINDINGS if f.source == source and f.rule_id in rule_ids]
        if wanted:
            any_found = reduce(Column.__or__, [F.coalesce(f.when(), F.lit(False)) for f in wanted])
            found = rows(t).where(any_found).select(F.inline(F.array(*[f.column() for f in wanted])))
            parts.append(found.where("rule_id is not null"))
    if not parts:
        return t.dim_product.sparkSession.createDataFrame([], "rule_id string, record_key string, issue_description string")
    return reduce(DataFrame.unionByName, parts)


def run_rule(t: Customer360, rule: Rule) -> DataFrame:
    return exceptions(t, [rule])


def exceptions(t: Customer360, rules: Sequence[Rule]) -> DataFrame:
    """Everything the catalog's rules find, in one table."""
    found = findings(t, {rule.rule_id for rule in rules})
    return found.join(_catalog(found.sparkSession, rules), "rule_id").select(EXCEPTION_COLUMNS)


def _catalog(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return constant_rows(spark, [{"place": place, **asdict(rule)} for place, rule in enumerate(rules)])


def _counts(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The catalog with the number of findings per rule, zero included; as long as the catalog."""
    n = found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    return _catalog(found.sparkSession, rules).join(n, "rule_id", "left").withColumn(
        "n_exceptions", F.coalesce("n", F.lit(0))
    ).drop("n")


def summary(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return _counts(found, rules).orderBy("place").select(
        "rule_id", "dataset", "severity", "rule_description", "n_exceptions"
    )


def totals(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return _counts(found, rules).agg(
        F.sum("n_exceptions").alias("n_exceptions"),
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(F.col("n_exceptions") > 0).alias("n_triggered"),
        F.count_if(F.col("n_exceptions") == 0).alias("n_passed"),
    )


def detail(found: DataFrame, rules: Sequence[Rule], store: Store = lambda _, df: df) -> DataFrame:
    """Findings per rule with the rule's status and its place in the catalog; a clean rule shows as one
    row without a record. The counts per rule are written, so that their size is known where they meet
    the findings, and the result is written, as it is sorted afterwards."""
    n = F.col("n_exceptions")
    status = store("rule_counts", _counts(found, rules)).select(
        "place",
        "rule_id",
        "rule_description",
        "dataset",
        "severity",
        F.when(n == 0, "passed clean").otherwise(F.concat(n.cast("string"), F.lit(" exception(s)"))).alias("status"),
        "suggested_action",
        n,
    )
    texts = found.select(
        "rule_id", "record_key", F.replace(F.col("issue_description"), F.lit("|"), F.lit("\\|")).alias("issue_description")
    )
    hit = status.where(n > 0)
    shown_rows = texts.join(hit, "rule_id").drop("n_exceptions")
    clean = status.where(n == 0).drop("n_exceptions").withColumns(
        {
            "record_key": F.lit(None).cast("string"),
            "issue_description": F.lit("No exceptions — this rule passed."),
        }
    )
    return store("detail_rows", shown_rows.unionByName(clean))
