"""All-text scans of CSV and JSON-lines files, and the metadata files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recon360.model import DEFAULT_QUESTIONS, DEFAULT_RULES, SEQ, Rule
from recon360.sources import quoted

UNEVEN_ROW = "_uneven_row"  # the text of a row with another number of fields than the header
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def _file_order() -> Column:
    """Position of a row in its source.

    Row numbers grow within one split whatever task reads it, and splits order by their offset, so
    comparing the three parts gives file order however Spark packs splits into tasks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def scan_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Header names the columns, every field is text, blank fields are ``''``, fields a row lacks NULL.

    All part files of a folder must have the same header: another order or name of columns is an error,
    not a shift of values. In a row that is too short the blanks before its last filled field stay
    blank.

    Files are read in parallel splits either way. Where fields span lines, lines are put together to
    records first (``quoted.records``), so by default a look at the quotes decides; ``multi_line=True``
    or ``False`` saves that look.
    """
    if multi_line is None:
        multi_line = quoted.fields_span_lines(spark, path)
    reader = spark.read.options(**CSV_FORMAT, inferSchema=False, multiLine=multi_line)
    columns = reader.csv(path).columns
    if multi_line:
        raw = quoted.parsed(quoted.records(spark, path), columns, UNEVEN_ROW, SEQ, {"quote": '"', "escape": '"'})
        place = F.col(SEQ)
    else:
        fields = [T.StructField(c, T.StringType()) for c in (*columns, UNEVEN_ROW)]
        checked = reader.options(enforceSchema=False, columnNameOfCorruptRecord=UNEVEN_ROW, columnPruning=False)
        raw = checked.schema(T.StructType(fields)).csv(path)
        place = _file_order()
    return raw.select(*[_field(columns, i).alias(c) for i, c in enumerate(columns)], place.alias(SEQ))


def _field(columns: list[str], i: int) -> Column:
    c, later = F.col(f"`{columns[i]}`"), [F.col(f"`{x}`").isNotNull() for x in columns[i + 1 :]]
    inside = F.coalesce(*[F.when(x, F.lit("")) for x in later]) if later else F.lit(None).cast("string")
    return F.when(F.col(UNEVEN_ROW).isNull(), F.coalesce(c, F.lit(""))).otherwise(F.coalesce(c, inside))


def _as_text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return (F.to_json(c) if nested else c.cast("string")).alias(field.name)


def scan_jsonl(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per line; scalars become text, nested values JSON text, null stays NULL.

    Columns are the union of all keys, which takes one pass to find; naming ``columns`` saves it.
    A broken line fails the read, blank lines are skipped.
    """
    reader = spark.read.options(primitivesAsString=True, mode="FAILFAST")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    raw = reader.json(path)
    return raw.select(*[_as_text(f) for f in raw.schema.fields], _file_order().alias(SEQ))


def with_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the declared columns the source lacks, as NULL text."""
    return df.select(
        "*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in df.columns]
    )


def load_rules(spark: SparkSession, path: str | None) -> list[Rule]:
    """The whole catalog in its order. A repeated id keeps its first place and its last text."""
    if path is None:
        return list(DEFAULT_RULES)
    catalog = with_columns(scan_csv(spark, path), ["suggested_action"])
    catalog = catalog.na.fill("", ["suggested_action"])
    fields = F.struct("rule_id", "dataset", "rule_description", "severity", "suggested_action")
    rows = (
        catalog.groupBy("rule_id")
        .agg(F.min(SEQ).alias("place"), F.max_by(fields, SEQ).alias("rule"))
        .orderBy("place")
        .collect()
    )
    return [Rule(**row["rule"].asDict()) for row in rows]


def load_questions(spark: SparkSession, path: str | None) -> list[str]:
    """All question texts in file order."""
    if path is None:
        return list(DEFAULT_QUESTIONS)
    rows = (
        scan_csv(spark, path)
        .select(F.trim("Questions").alias("question"), SEQ)
        .where("question <> ''")
        .orderBy(SEQ)
        .collect()
    )
    return [row["question"] for row in rows]


def load_mapping(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Target columns per curated table, in mapping order."""
    rows = (
        scan_csv(spark, path)
        .groupBy("target_table")
        .agg(F.min(SEQ).alias("place"), F.sort_array(F.collect_list(F.struct(SEQ, "target_column"))).alias("cols"))
        .orderBy("place")
        .collect()
    )
    return {row["target_table"]: [c["target_column"] for c in row["cols"]] for row in rows}
