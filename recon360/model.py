"""Table shapes, the rule catalog and the question catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SEQ = "_seq"
"""Ordering column of a staging table: smaller means earlier in the source."""

# Source columns of the five staging tables, all text.
STAGING_COLUMNS = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone",
        "country", "state", "signup_date", "loyalty_tier",
    ],
    "products": ["product_id", "product_name", "category", "unit_price", "active_flag"],
    "orders": [
        "order_id", "customer_id", "order_ts", "product_id", "quantity",
        "order_status", "shipping_state", "order_total",
    ],
    "payments": ["payment_id", "order_id", "payment_ts", "payment_method", "payment_status", "amount"],
    "support_tickets": [
        "ticket_id", "customer_id", "created_ts", "channel", "category", "sentiment", "description",
    ],
}

# Columns of the curated tables; the first one is the key.
CURATED_COLUMNS = {
    "dim_customer": [
        "customer_key", "full_name", "email", "phone", "standard_country", "standard_state",
        "signup_date", "loyalty_tier", "duplicate_resolution_flag",
    ],
    "dim_product": ["product_key", "product_name", "category", "unit_price", "active_flag"],
    "fact_order": [
        "order_key", "customer_key", "product_key", "order_date", "quantity", "order_status",
        "shipping_state", "gross_order_amount", "calculated_order_amount", "order_amount_variance",
    ],
    "fact_payment": [
        "payment_key", "order_key", "payment_date", "payment_method", "payment_status", "payment_amount",
    ],
    "fact_customer_issue": [
        "ticket_id", "customer_key", "created_date", "channel", "issue_category", "sentiment", "description",
    ],
    "dq_exception_report": [
        "rule_id", "dataset", "record_key", "severity", "issue_description", "suggested_action",
    ],
}
EXCEPTION_COLUMNS = CURATED_COLUMNS["dq_exception_report"]

# 18 digits before the point and six after it; an amount beyond that fails the job, it is never dropped
AMOUNT = T.DecimalType(24, 6)
DERIVED_AMOUNT = T.DecimalType(38, 4)

# Everything not named here is text.
COLUMN_TYPES: dict[str, T.DataType] = {
    "unit_price": AMOUNT,
    "gross_order_amount": AMOUNT,
    "calculated_order_amount": DERIVED_AMOUNT,
    "order_amount_variance": DERIVED_AMOUNT,
    "payment_amount": AMOUNT,
    "duplicate_resolution_flag": T.IntegerType(),
    "active_flag": T.IntegerType(),
    "quantity": T.LongType(),
    "signup_date": T.DateType(),
    "order_date": T.DateType(),
    "payment_date": T.DateType(),
    "created_date": T.DateType(),
}


def curated_schema(columns: dict[str, list[str]] = CURATED_COLUMNS) -> dict[str, T.StructType]:
    """Target schemas for a mapping ``table -> ordered columns``."""
    return {
        table: T.StructType([T.StructField(c, COLUMN_TYPES.get(c, T.StringType())) for c in names])
        for table, names in columns.items()
    }


@dataclass(frozen=True)
class Staging:
    """The five raw tables: text columns plus the ordering column ``_seq``."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    payments: DataFrame
    support_tickets: DataFrame


@dataclass(frozen=True)
class Rule:
    rule_id: str
    dataset: str
    rule_description: str
    severity: str
    suggested_action: str


# The data-quality rule catalog used when the input folder brings none.
DEFAULT_RULES = [
    Rule("DQ001", "customers", "exact duplicate customer_ids exist in source data", "High",
         "No further action needed"),
    Rule("DQ002", "customers", "email is missing or absent for a customer", "Medium",
         "Contact the customer to obtain a valid email address and update the source record; "
         "flag account for manual outreach"),
    Rule("DQ003", "customers", "country or state value is non-standard (full name or variant spelling)",
         "Medium", "No further action needed"),
    Rule("DQ004", "orders", "exact duplicate order_ids exist in source data", "High",
         "No further action needed"),
    Rule("DQ005", "orders", "order references a customer_id not present in the customers dataset", "High",
         "Verify and correct the customer_id on the order; quarantine the order for manual review "
         "if the customer cannot be found"),
    Rule("DQ006", "orders", "order references a product_id not present in the products dataset", "High",
         "Verify and correct the product_id on the order; mark for review if the product cannot be identified"),
    Rule("DQ007", "orders", "completed order has a non-positive quantity", "High",
         "Investigate for data-entry error; correct the quantity or reclassify the order status "
         "(e.g. returned or cancelled)"),
    Rule("DQ008", "orders", "stated order_total does not match quantity x unit_price", "High",
         "Reconcile the order total with line-item pricing; escalate discrepancy to finance "
         "for adjustment or repricing"),
    Rule("DQ009", "payments", "payment references an order_id not present in the orders dataset", "High",
         "Trace the orphan payment to its correct order; link or initiate a finance write-off if unresolvable"),
    Rule("DQ010", "payments", "settled payment amount differs from the completed order total", "High",
         "Reconcile the settled amount with the order total; initiate a payment adjustment "
         "or chargeback as appropriate"),
    Rule("DQ011", "support_tickets", "ticket created_ts cannot be parsed to a valid timestamp", "Medium",
         "Correct the malformed timestamp in the source system; enforce ISO 8601 format "
         "(YYYY-MM-DD HH:MM:SS) at ticket creation"),
    Rule("DQ012", "support_tickets", "ticket references a customer_id not present in the customers dataset",
         "Medium",
         "Verify the customer reference on the ticket; link to the correct customer "
         "or create a new customer record"),
    Rule("DQ013", "customers",
         "different customer_ids resolve to the same person via name and contact-info matching", "High",
         "Verify the diplicates via the id_crosswalk table; currently it has been updated using the "
         "most complete or if both complete, the lowest customer_key"),
    Rule("DQ014", "orders", "order references a product with active_flag = 0 (discontinued product)", "Medium",
         "Remove the inactive product from the order or reactivate the product; verify fulfilment "
         "capability and review pricing before shipment"),
]

# The business questions, in report order.
DEFAULT_QUESTIONS = [
    "What is completed revenue by month?",
    "Who are the top 10 customers by completed order value?",
    "Which orders have payment mismatches, missing payments, invalid customer references, "
    "invalid product references, or suspicious quantities?",
    "Which states have the highest completed revenue?",
    "Is there any visible relationship between negative support tickets and order/payment exceptions?",
]
