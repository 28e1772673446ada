"""Every operator, rule, answer and check as a query over the order tables in a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recon360.functions import parsing, text
from recon360.model import CURATED_COLUMNS, DEFAULT_RULES, EXCEPTION_COLUMNS, SEQ, STAGING_COLUMNS, Rule
from recon360.operators import dedup, entity, references
from recon360.operators import survivors as survivor_rules
from recon360.plans import answers, checks, conform, job, rules
from recon360.plans.conform import Customer360
from recon360.plans.history import History, trend
from recon360.session import input_bytes, prepare, scratch_root, size_for
from recon360.sources import files, mapping, sinks
from recon360.sources.bound import BoundStaging
from recon360.sources.store import TableStore, constant_rows
from recon360.streaming.clusters import Clusters
from recon360.streaming.orders import OrderFacts
from recon360.streaming.unique import keep_unique, late_rows, read_unique

STREAM_PARTITIONS = 8


class Run(Customer360):
    """The tables of one folder, plus the exception table and text copies of two sources."""

    def __init__(self, spark: SparkSession, sf_dir: str, number: int):
        self.spark, self.sf_dir = spark, sf_dir
        self.files = TableStore(spark, f"{scratch_root(spark)}/run_{number}", codec="zstd")
        super().__init__(BoundStaging(spark, sf_dir, self.files), self.files)
        self._exceptions: DataFrame | None = None

    @property
    def exceptions(self) -> DataFrame:
        if self._exceptions is None:
            self._exceptions = self.files("dq_exception_report", rules.exceptions(self, DEFAULT_RULES))
        return self._exceptions


_runs: dict[tuple, Run] = {}
SOURCE_TABLES = ("customer", "part", "orders", "lineitem", "events")


def _modified(spark: SparkSession, sf_dir: str) -> tuple[int, ...]:
    """When the tables of a folder were last written, on any file system Spark can read."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet") for name in SOURCE_TABLES]
    return tuple(p.getFileSystem(conf).getFileStatus(p).getModificationTime() for p in paths)


def open_run(spark: SparkSession, sf_dir: str) -> Run:
    """One run per session and folder, so that queries share the tables written so far.

    A folder whose tables were written anew, or a session whose scratch tables were dropped, begins another.
    """
    prepare(spark)
    size_for(spark, input_bytes(spark, *[f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]))
    key = (scratch_root(spark), str(sf_dir), _modified(spark, str(sf_dir)))
    if key not in _runs:
        _runs[key] = Run(spark, str(sf_dir), len(_runs))
    return _runs[key]


def as_result(df: DataFrame) -> DataFrame:
    """Amounts leave as plain numbers; order columns stay inside."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
            if not f.name.startswith("_")
        ]
    )


# --- sources and sinks


def scan_csv_text(run: Run) -> DataFrame:
    """Customers written as quoted CSV text and scanned back."""
    path = run.files.fresh("customers_csv")
    sinks.write_csv(run.staging.customers.drop(SEQ), path)
    return files.scan_csv(run.spark, path)


def scan_jsonl_text(run: Run) -> DataFrame:
    path = run.files.fresh("tickets_jsonl")
    run.staging.support_tickets.drop(SEQ).write.mode("overwrite").json(path)
    return files.scan_jsonl(run.spark, path)


def scan_csv_lines(run: Run) -> DataFrame:
    """Tickets written as CSV with a field over several lines and scanned back."""
    path = run.files.fresh("tickets_csv")
    note = F.concat_ws("\n", F.concat(F.lit('said "'), "sentiment", F.lit('",')), F.lit(""), "description")
    sinks.write_csv(run.staging.support_tickets.select("ticket_id", "channel", note.alias("note"), "category"), path)
    return files.scan_csv(run.spark, path)


def dq_catalog_file(run: Run) -> DataFrame:
    """Findings by a catalog file of other order, severity and advice, without one rule and with an unknown one."""
    path = run.files.fresh("catalog_csv")
    listed = [replace(r, severity=f"S{i % 3}", suggested_action=f"ask {r.dataset}") for i, r in enumerate(DEFAULT_RULES)]
    listed = [Rule("DQ900", "orders", "not built, yet", "S9", ""), *reversed(listed[1:])]
    rows = constant_rows(run.spark, [{"place": i, **asdict(r)} for i, r in enumerate(listed)])
    sinks.write_csv(rows.coalesce(1).sortWithinPartitions("place").drop("place"), path)
    catalog = files.load_rules(run.spark, path)
    found = run.files("dq_exceptions_by_file", rules.exceptions(run, catalog))
    rows = rules.detail(found, catalog, run.work)
    return rows.groupBy("place", "rule_id", "dataset", "severity", "suggested_action", "status").agg(
        F.count("record_key").alias("n_records"), F.min("record_key").alias("first_record")
    )


def dq_exceptions_export(run: Run) -> DataFrame:
    """The exported CSV, read back."""
    path = run.files.fresh("exceptions_csv")
    sinks.export_exceptions(run.exceptions, path)
    return files.scan_csv(run.spark, path)


def staging_row_counts(run: Run) -> DataFrame:
    parts = [
        getattr(run.staging, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in STAGING_COLUMNS
    ]
    return _union(parts)


def curated_schema(run: Run) -> DataFrame:
    """Columns of the curated tables with type, key mark and how many rows fill them."""
    tables = {**run.curated(), "dq_exception_report": run.exceptions}
    parts = []
    for name, columns in CURATED_COLUMNS.items():
        df = tables[name]
        keyed = name != "dq_exception_report"
        rows = ", ".join(
            f"{i}, '{c}', '{df.schema[c].dataType.simpleString()}', {int(keyed and i == 1)}, n_rows, `{c}`"
            for i, c in enumerate(columns, start=1)
        )
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in columns])
        parts.append(
            counts.selectExpr(
                f"'{name}' as table_name",
                f"stack({len(columns)}, {rows}) as (position, column_name, data_type, is_key, n_rows, n_filled)",
            )
        )
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- column expressions


def _applied(df: DataFrame, key: str, raw: str, name: str, expression: Callable[[Column], Column]) -> DataFrame:
    return df.select(key, F.col(raw).alias("raw_value"), expression(F.col(raw)).alias(name))


def parse_dates(run: Run) -> DataFrame:
    sources = [("orders", "order_id", "order_ts"), ("customers", "customer_id", "signup_date"),
               ("support_tickets", "ticket_id", "created_ts")]
    return _union(
        [
            getattr(run.staging, table).select(
                F.col(key).alias("record_key"),
                F.col(raw).alias("raw_value"),
                parsing.parse_date(F.col(raw)).alias("parsed_date"),
            )
            for table, key, raw in sources
        ]
    )


def normalize_country(run: Run) -> DataFrame:
    return _applied(run.staging.customers, "customer_id", "country", "standard_country", text.normalize_country)


def normalize_state(run: Run) -> DataFrame:
    return _applied(run.staging.orders, "order_id", "shipping_state", "standard_state", text.normalize_state)


def parse_money(run: Run) -> DataFrame:
    products = _applied(run.staging.products, "product_id", "unit_price", "amount", parsing.parse_money)
    orders = _applied(run.staging.orders, "order_id", "order_total", "amount", parsing.parse_money)
    return _union([products.withColumnRenamed("product_id", "record_key"), orders.withColumnRenamed("order_id", "record_key")])


def parse_quantity(run: Run) -> DataFrame:
    return _applied(run.staging.orders, "order_id", "quantity", "quantity", parsing.parse_quantity)


def decode_active_flag(run: Run) -> DataFrame:
    return _applied(run.staging.products, "product_id", "active_flag", "active_flag", parsing.decode_active_flag)


def full_name(run: Run) -> DataFrame:
    return run.staging.customers.select(
        "customer_id", text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    )


def clean_contact(run: Run) -> DataFrame:
    return run.staging.customers.select(
        "customer_id",
        text.clean_email(F.col("email")).alias("email"),
        text.clean_phone(F.col("phone")).alias("phone"),
    )


def match_keys(run: Run) -> DataFrame:
    return entity.match_keys(run.staging.customers)


def completeness(run: Run) -> DataFrame:
    df = run.staging.customers
    return df.select("customer_id", text.completeness(dedup.business_columns(df)).alias("n_filled"))


# --- deduplication and entity resolution


def duplicate_pairs(run: Run) -> DataFrame:
    """Each id with the smallest id that shares its name and phone or email; linear in the ids."""
    return entity.shared_key_links(entity.match_keys(run.customers), run.work)


def duplicate_ids(run: Run) -> DataFrame:
    return _union(
        [
            dedup.duplicate_ids(run.staging.customers, "customer_id").withColumn("table_name", F.lit("customers")),
            dedup.duplicate_ids(run.staging.orders, "order_id").withColumn("table_name", F.lit("orders")),
        ]
    )


def canonical_customers(run: Run) -> DataFrame:
    gone = run.id_crosswalk.select(F.col("old_customer_id").alias("customer_id"))
    return run.customers.select("customer_id").join(gone, "customer_id", "left_anti")


def merged_flag(run: Run) -> DataFrame:
    return entity.with_merge_flag(run.customers, run.id_crosswalk).select("customer_id", "duplicate_resolution_flag")


# --- joins and derived columns


def crosswalk_remap(run: Run) -> DataFrame:
    rows = run.staging.support_tickets.select("ticket_id", "customer_id")
    return references.crosswalk_remap(rows, run.id_crosswalk, "customer_id")


def fk_resolve_orders(run: Run) -> DataFrame:
    rows = dedup.keep_first(run.staging.orders.select("order_id", "customer_id", "product_id", SEQ), "order_id")
    return references.resolve_product(references.resolve_customer(rows, run.clusters), run.dim_product).select(
        "order_id", "customer_id", "product_id", "customer_key", "product_key"
    )


def fk_resolve_payments(run: Run) -> DataFrame:
    return references.resolve_order(run.staging.payments.select("payment_id", "order_id"), run.fact_order)


def fk_resolve_tickets(run: Run) -> DataFrame:
    return references.resolve_customer(run.staging.support_tickets.select("ticket_id", "customer_id"), run.clusters)


def order_amounts(run: Run) -> DataFrame:
    rows = dedup.keep_first(run.staging.orders, "order_id").select(
        "order_id",
        "product_id",
        parsing.parse_quantity(F.col("quantity")).alias("quantity"),
        parsing.parse_money(F.col("order_total")).alias("gross_order_amount"),
    )
    return conform.order_amounts(references.resolve_product(rows, run.dim_product)).select(
        "order_id", "quantity", "unit_price", "gross_order_amount", "calculated_order_amount", "order_amount_variance"
    )


def orders_with_payments(run: Run) -> DataFrame:
    columns = ("order_key", "order_status", "gross_order_amount")
    paid = run.order_payments.select(*columns, "payment_key", "payment_status", "payment_amount")
    return references.with_unpaid(run.fact_order.select(*columns), paid)


def trace_to_raw(run: Run) -> DataFrame:
    return run.order_trace.select("order_key", "customer_id", "product_id")


# --- batches, survivors, runs and metadata


def fact_order_batches(run: Run) -> DataFrame:
    """Orders taken in by three loads with a high-water mark; ids that repeat come in different loads."""
    facts = OrderFacts(run.spark, run.files.fresh("order_batches"), mark="load", buckets=16)
    loads = run.staging.orders.withColumn("load", F.col(f"{SEQ}.l_suppkey") % 3)
    for last in (0, 1, 2):
        facts.add(loads.where(F.col("load") <= last), run.clusters, run.dim_product)
    return facts.read()


def entity_clusters_batches(run: Run) -> DataFrame:
    """Customers taken in by three batches."""
    state = Clusters(run.spark, run.files.fresh("cluster_batches"), buckets=16)
    part = F.pmod(F.xxhash64("customer_id"), F.lit(3))
    for i in range(3):
        state.add(run.customers.where(part == i), run.files)
    return state.clusters()


def events_unique(run: Run) -> DataFrame:
    """Events from files that repeat some and bring some too late, read as a stream in two runs.

    The first file has the earlier events, the second the later ones and half of the earlier ones again;
    of every 97th event the only row comes in the third file, when the watermark is long past.
    """
    path = run.files.fresh("events_stream")
    events = run.spark.read.parquet(f"{run.sf_dir}/events.parquet")
    events = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    at = F.unix_micros("ts")
    low, high = events.agg(F.min(at), F.max(at)).first()
    early = 2 * at < low + high
    late = early & (F.col("event_id") % 97 == 0)
    again = early & ~late & (F.col("event_id") % 2 == 0)
    parts = [events.where(early & ~late), events.where(~early).unionByName(events.where(again)), events.where(late)]
    delay = f"{(high - low) // 4_000_000 + 1} seconds"
    before = run.spark.conf.get("spark.sql.shuffle.partitions")
    run.spark.conf.set("spark.sql.shuffle.partitions", STREAM_PARTITIONS)  # fixed for good when a stream first starts
    try:
        for i, part in enumerate(parts):
            part.coalesce(1).write.mode("overwrite").parquet(f"{path}/source/part={i}")
            keep_unique(run.spark, events.schema, f"{path}/source/part=*", f"{path}/unique", f"{path}/checkpoint", "event_id", "ts", delay)
    finally:
        run.spark.conf.set("spark.sql.shuffle.partitions", before)
    unique = read_unique(run.spark, events.schema, f"{path}/unique").withColumn("state", F.lit("kept"))
    missed = late_rows(run.spark, events.schema, f"{path}/source/part=*", f"{path}/unique", "event_id").withColumn("state", F.lit("late"))
    return unique.select("event_id", "user_id", "event_type", "state").unionByName(missed.select("event_id", "user_id", "event_type", "state"))


def survivors(run: Run, strategy: str) -> DataFrame:
    elected = run.files(f"elected_{strategy}", survivor_rules.elect(run.customers, run.id_crosswalk, survivor_rules.STRATEGIES[strategy]))
    return survivor_rules.surviving_customers(run.customers, run.id_crosswalk, elected)


def survivor_crosswalk(run: Run) -> DataFrame:
    elected = run.files("elected", survivor_rules.elect(run.customers, run.id_crosswalk, survivor_rules.STRATEGIES["latest_signup"]))
    return survivor_rules.rerooted(run.id_crosswalk, elected)


def dq_trend(run: Run) -> DataFrame:
    """Three runs over a growing share of the findings; the second is repeated after a wrong first try."""
    history = History(run.spark, run.files.fresh("dq_history"))
    digit = F.substring("record_key", -1, 1)
    for number, digits in ((1, "012"), (2, "0123456789"), (2, "0124"), (3, "0123456789")):
        history.record(number, rules.summary(run.exceptions.where(digit.isin(list(digits))), DEFAULT_RULES))
    return trend(history.read())


def dim_product_mapped(run: Run) -> DataFrame:
    """Products by a mapping file alone, with a column the built-in table does not have."""
    path = run.files.fresh("mapping_csv")
    listed = [
        ("product_key", "product_id", ""), ("product_name", "product_name", ""), ("kind_of_product", "category", "text"),
        ("unit_price", "unit_price", ""), ("price_as_stated", "unit_price", "text"), ("active_flag", "active_flag", ""),
        ("label", "category,product_name", "name"),
    ]
    rows = [
        {"target_table": "dim_product", "target_column": t, "source_column": s, "kind": k, "place": i} for i, (t, s, k) in enumerate(listed)
    ]
    table = constant_rows(run.spark, rows).coalesce(1).sortWithinPartitions("place").drop("place")
    sinks.write_csv(table, path)
    return mapping.project(run.staging.products, mapping.load(run.spark, path)["dim_product"])


def answer_states(run: Run) -> DataFrame:
    """Questions of a file with their answers' states: one answer has no rows, one fails, one question has none."""
    path = run.files.fresh("questions_csv")
    asked = ["What is revenue, by month?", "Which states?", "Which month in the year 1?", "Which one fails?", "Who knows?"]
    sinks.write_csv(constant_rows(run.spark, [{"place": i, "Questions": q} for i, q in enumerate(asked)]).coalesce(1).drop("place"), path)

    def fails(t: Customer360) -> DataFrame:
        raise ValueError("no such table")

    known = {
        "bq1": answers.revenue_by_month, "bq4": answers.revenue_by_state,
        "empty": lambda t: answers.revenue_by_month(t).where("month < '0002'"), "fails": fails,
    }
    questions = files.load_questions(run.spark, path)
    return job.answer_states(run.spark, questions, job.write_answers(run, questions, run.files.fresh("answers"), known), known)


Query = Callable[[Run], DataFrame]

QUERIES: dict[str, Query] = {
    "scan_csv_text": scan_csv_text,
    "scan_jsonl_text": scan_jsonl_text,
    "staging_row_counts": staging_row_counts,
    "curated_schema": curated_schema,
    "parse_dates": parse_dates,
    "normalize_country": normalize_country,
    "normalize_state": normalize_state,
    "parse_money": parse_money,
    "parse_quantity": parse_quantity,
    "decode_active_flag": decode_active_flag,
    "full_name": full_name,
    "clean_contact": clean_contact,
    "match_keys": match_keys,
    "completeness": completeness,
    "duplicate_ids": duplicate_ids,
    "dedup_most_complete": lambda run: dedup.keep_most_complete(run.staging.customers, "customer_id"),
    "dedup_first": lambda run: dedup.keep_first(run.staging.orders, "order_id"),
    "duplicate_pairs": duplicate_pairs,
    "entity_clusters": lambda run: run.clusters,
    "id_crosswalk": lambda run: run.id_crosswalk,
    "canonical_customers": canonical_customers,
    "merged_flag": merged_flag,
    "crosswalk_remap": crosswalk_remap,
    "fk_resolve_orders": fk_resolve_orders,
    "fk_resolve_payments": fk_resolve_payments,
    "fk_resolve_tickets": fk_resolve_tickets,
    "order_amounts": order_amounts,
    "orders_with_payments": orders_with_payments,
    "trace_to_raw": trace_to_raw,
    "fact_order_batches": fact_order_batches,
    "entity_clusters_batches": entity_clusters_batches,
    "events_unique": events_unique,
    "survivors_most_complete": lambda run: survivors(run, "most_complete"),
    "survivors_latest_signup": lambda run: survivors(run, "latest_signup"),
    "survivor_crosswalk": survivor_crosswalk,
    "dq_trend": dq_trend,
    "dim_product_mapped": dim_product_mapped,
    "answer_states": answer_states,
    "dim_customer": lambda run: run.dim_customer,
    "dim_product": lambda run: run.dim_product,
    "fact_order": lambda run: run.fact_order,
    "fact_payment": lambda run: run.fact_payment,
    "fact_customer_issue": lambda run: run.fact_customer_issue,
    **{rule.rule_id.lower(): (lambda run, rule=rule: rules.run_rule(run, rule)) for rule in DEFAULT_RULES},
    "dq_exceptions": lambda run: run.exceptions.select(EXCEPTION_COLUMNS),
    "dq_exceptions_export": dq_exceptions_export,
    "dq_summary": lambda run: rules.summary(run.exceptions, DEFAULT_RULES),
    "dq_totals": lambda run: rules.totals(run.exceptions, DEFAULT_RULES),
    "dq_detail": lambda run: sinks.sorted_by(
        rules.detail(run.exceptions, DEFAULT_RULES, run.work), "place", "record_key"
    ).drop("place"),
    "dq_catalog_file": dq_catalog_file,
    "scan_csv_lines": scan_csv_lines,
    **answers.ANSWERS,
    "check_row_accounting": lambda run: checks.row_accounting(run, run.exceptions),
    "check_referential": lambda run: checks.referential(run, run.exceptions),
    "check_amounts": lambda run: checks.amounts(run, run.exceptions),
    "check_parsing": lambda run: checks.parsing(run, run.exceptions),
    "check_key_unique": checks.key_unique,
}
