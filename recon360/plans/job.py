"""The whole run as one Spark job: files in, curated tables, exceptions, reports and answers out."""

from __future__ import annotations

import logging
import uuid
from itertools import zip_longest
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from recon360.model import CURATED_COLUMNS, STAGING_COLUMNS, Staging, curated_schema
from recon360.operators import entity
from recon360.plans import answers, checks, rules
from recon360.plans.conform import Customer360, fit
from recon360.session import input_bytes, prepare, scratch_root, size_for
from recon360.sources import files, mapping, sinks
from recon360.sources.store import TableStore, constant_rows

log = logging.getLogger(__name__)

# File names in the input folder.
SOURCES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "payments": "payments.csv",
    "support_tickets": "support_tickets.jsonl",
}
RULES_FILE = "data_quality_rules.csv"
MAPPING_FILE = "sttm_target_mapping.csv"
QUESTIONS_FILE = "business_questions.csv"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load_staging(spark: SparkSession, input_dir: str, store: TableStore) -> Staging:
    """Every source as all-text Parquet, replaced as a whole on each run.

    Each name may be a file or a folder of part files. Columns a source lacks come as NULL.
    """
    tables = {}
    for name, file in SOURCES.items():
        path = f"{input_dir}/{file}"
        raw = files.scan_csv(spark, path) if file.endswith(".csv") else files.scan_jsonl(spark, path)
        tables[name] = store(f"staging_{name}", files.with_columns(raw, STAGING_COLUMNS[name]))
    return Staging(**tables)


def write_answers(
    t: Customer360, questions: list[str], output_dir: str, known: Mapping[str, answers.Answer] = answers.ANSWERS
) -> dict[str, str]:
    """One CSV per question, NULL written as such; a failing question does not stop the others.

    Returns the state of each answer: ``ok``, ``no results`` or the error.
    """
    states = {}
    for question, (name, answer) in zip(questions, known.items()):
        try:
            path = f"{output_dir}/answers/{name}"
            rows = answer(t)
            sinks.write_csv(rows, path, null="NULL")
            states[name] = "no results" if files.scan_csv(rows.sparkSession, path, multi_line=False).isEmpty() else "ok"
        except Exception as error:  # noqa: BLE001 - reported per question
            log.exception("no answer to %r", question)
            states[name] = str(error)
    return states


def answer_states(
    spark: SparkSession, questions: list[str], states: Mapping[str, str], known: Mapping[str, answers.Answer] = answers.ANSWERS
) -> DataFrame:
    """One row per question in its place; one without an answer of its own is ``unanswered``."""
    rows = [
        {"position": i, "answer": name, "question": question, "state": states.get(name, "unanswered")}
        for i, (question, name) in enumerate(zip_longest(questions, known, fillvalue=""), start=1)
        if question
    ]
    return constant_rows(spark, rows)


def run(
    spark: SparkSession, input_dir: str, output_dir: str, match_on: Mapping[str, str] = entity.MATCH_ON
) -> dict[str, DataFrame]:
    """Read, conform, check and answer. Running it again gives the same output."""
    prepare(spark)
    size_for(spark, input_bytes(spark, input_dir))
    store = TableStore(spark, output_dir)

    def metadata(file: str) -> str | None:
        path = f"{input_dir}/{file}"
        return path if exists(spark, path) else None

    mapping_file = metadata(MAPPING_FILE)
    columns = files.load_mapping(spark, mapping_file) if mapping_file else CURATED_COLUMNS
    mapped = mapping.load(spark, mapping_file) if mapping_file else {}
    work = TableStore(spark, f"{scratch_root(spark)}/job-{uuid.uuid4().hex}", codec="zstd")
    t = Customer360(load_staging(spark, input_dir, store), store, match_on, curated_schema(columns), work, mapped)

    tables = {"id_crosswalk": store("id_crosswalk", t.id_crosswalk), **t.curated()}
    checks.require_unique_keys(t)

    catalog = files.load_rules(spark, metadata(RULES_FILE))
    for rule in catalog:
        if rule.rule_id not in rules.RULES:
            log.warning("no function for rule %s; it is reported with no findings", rule.rule_id)
    found = store("dq_exception_report", fit(rules.exceptions(t, catalog), t.schemas["dq_exception_report"]))
    sinks.export_exceptions(found, f"{output_dir}/exceptions_csv")
    tables["dq_exception_report"] = found
    tables["dq_summary"] = store("dq_summary", rules.summary(found, catalog))
    tables["dq_totals"] = store("dq_totals", rules.totals(found, catalog))
    tables["dq_detail"] = store("dq_detail", sinks.sorted_by(rules.detail(found, catalog, work), "place", "record_key").drop("place"))

    questions = files.load_questions(spark, metadata(QUESTIONS_FILE))
    states = write_answers(t, questions, output_dir)
    if len(questions) != len(answers.ANSWERS):
        log.warning("%d questions for %d answers", len(questions), len(answers.ANSWERS))
    tables["answers"] = store("answer_states", answer_states(spark, questions, states))
    tables["checks"] = store("checks", checks.all_checks(t, found).orderBy("check_name"))
    return tables
