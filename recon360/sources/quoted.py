"""CSV files with fields that span lines, read in parallel splits.

Whether a line begins inside a quoted field depends on all lines before it, but what a line does to that
state does not: it is a function of two states, found by two regular expressions. Functions of
consecutive lines compose, so a first pass reduces every split to one function, a prefix over the
splits of a file tells in which state each split begins, and a second pass puts the lines of each split
together to records. Only the records that cross the end of a split meet over the network.

A quote counts where the CSV reader counts it: at the start of a field, or within a field that began
with one. A quote further on in a plain field is text and changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Possessive throughout: one way to read a line, no backtracking and no recursion.
_REST = r'[^"]*+(?:""[^"]*+)*+'  # of a quoted field, up to the quote that closes it
_FIELD = rf'(?:"{_REST}"[^,]*+|[^",][^,]*+|(?=,))'
_OPENS = rf'\A(?:{_FIELD},)*+"{_REST}\z'
_STAYS = rf'\A{_REST}(?:\z|"[^,]*+,(?:{_FIELD},)*+"{_REST}\z)'

WHOLE, BEGINS, GOES_ON = 0, 1, 2

# Workers get the functions themselves, so they need not find this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are between line feeds, with their place and what they do to the state."""
    value = F.col("value")
    quoted = F.contains(value, F.lit('"'))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (quoted & value.rlike(_OPENS)).alias("opens"),  # outside before it, inside after it
        (~quoted | value.rlike(_STAYS)).alias("stays"),  # inside before it and after it
        F.make_valid_utf8(value).alias("value"),
    )


def fields_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether any line ends within a quoted field."""
    return not _lines(spark, path).where("opens").isEmpty()


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Consecutive rows of one split each."""
    if batch.num_rows == 0:
        return
    files, blocks = batch.column("file"), batch.column("block").to_numpy()
    names = files.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield (files[int(start)].as_py(), int(blocks[start])), batch.slice(int(start), int(end - start))


def states_after(opens: np.ndarray, stays: np.ndarray, state: bool) -> np.ndarray:
    """Whether each line ends inside a quoted field, when ``state`` tells so of the line before."""
    fixed, flips = opens == stays, np.cumsum(opens & ~stays)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(opens)), -1))
    known = last >= 0
    start = np.where(known, opens[last], state)
    return start ^ ((flips - np.where(known, flips[last], 0)) % 2 == 1)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split the state at its end, if it begins outside and if it begins inside."""
    now, ends = None, (False, True)
    names = ["file", "block", "if_outside", "if_inside"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, [*now, *ends], strict=True))])

    for batch in batches:
        for split, run in _runs(batch):
            if now is not None and split != now:
                yield row()
            if split != now:
                now, ends = split, (False, True)
            opens, stays = (run.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
            ends = tuple(bool(states_after(opens, stays, e)[-1]) for e in ends)
    if now is not None:
        yield row()


def _entries(lines: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin inside a quoted field.

    The window sees one row per split. A split that ends in the same state however it begins settles
    the state; between such splits those that turn it round are counted.
    """
    functions = lines.select("file", "block", "opens", "stays").mapInArrow(
        _functions, "file string, block long, if_outside boolean, if_inside boolean"
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("if_outside") & ~F.col("if_inside")).cast("int")
    counted = functions.withColumn("turned", F.sum(turns).over(order))
    settled = F.when(F.col("if_outside") == F.col("if_inside"), F.struct("if_outside", "turned"))
    seen = counted.select(
        "file",
        "block",
        F.coalesce(F.max("turned").over(before), F.lit(0)).alias("turned"),
        F.last(settled, ignorenulls=True).over(before).alias("settled"),
    )
    start = F.coalesce(F.col("settled.if_outside"), F.lit(False))
    since = F.col("turned") - F.coalesce(F.col("settled.turned"), F.lit(0))
    return seen.where(start != (since % 2 == 1)).select("file", "block")


_PIECES = "file string, block long, row long, first boolean, part int, record string"
_PIECE = pa.schema(
    [
        ("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("first", pa.bool_()), ("part", pa.int32()),
        ("record", pa.string()),
    ]
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split; what began before the split or goes on after it as parts of records."""
    now, state, first = None, False, False
    row, held = None, []  # the record under way: place of its first line, None if that is in another split

    def piece(goes_on: bool) -> tuple:
        nonlocal first
        record = "\n".join(held)
        head = first and row is not None and record.strip() != ""
        first = first and not head
        part = (BEGINS if goes_on else WHOLE) if row is not None else GOES_ON
        return (*now, row if row is not None else place, head, part, record)

    for batch in batches:
        out = []
        for split, run in _runs(batch):
            if split != now:
                if held:
                    out.append(piece(state))
                now, state, held, row, first = split, bool(run.column("inside")[0].as_py()), [], None, split[1] == 0
                place = run.column("row")[0].as_py()
            opens, stays = (run.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
            after = states_after(opens, stays, state)
            before = np.concatenate(([state], after[:-1]))
            rows, values = run.column("row").to_numpy(), run.column("value").to_pylist()
            starts = np.flatnonzero(~before).tolist()
            held += values[: starts[0] if starts else len(values)]
            for start, end in zip(starts, [*starts[1:], len(values)], strict=False):
                if held:
                    out.append(piece(False))
                row, held = int(rows[start]), values[start:end]
            state = bool(after[-1])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECE, strict=True)], schema=_PIECE)
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(_PIECE.names, piece(state), strict=True))], schema=_PIECE)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (the text of one, without its line end), ``first`` (of its file) and its place: file,
    block and row, which grow with the record's place in the source. Blank records are left out.

    A field that is never closed reaches to the end of its file, as for a reader of the whole file.
    """
    lines = _lines(spark, path)
    entries = _entries(lines).withColumn("inside", F.lit(True))
    # One row for each split that begins inside a field: at 128 MB a split, some ten thousand for each TB.
    placed = lines.join(F.broadcast(entries), ["file", "block"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    pieces = placed.select("file", "block", "row", "opens", "stays", "inside", "value").mapInArrow(_pieces, _PIECES)
    by_place = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.where(F.col("part") != WHOLE).withColumn("n", F.sum((F.col("part") == BEGINS).cast("int")).over(by_place))
    texts = F.sort_array(F.collect_list(F.struct("block", "row", "first", "record")))
    joined = numbered.groupBy("file", "n").agg(texts.alias("of")).select(
        "file",
        F.col("of.block")[0].alias("block"),
        F.col("of.row")[0].alias("row"),
        F.col("of.first")[0].alias("first"),
        F.array_join("of.record", "\n").alias("record"),
    )
    whole = pieces.where(F.col("part") == WHOLE).drop("part")
    line_end = F.regexp_replace("record", "\r$", "")
    return whole.unionByName(joined).withColumn("record", line_end).where(F.trim("record") != "")


def parsed(found: DataFrame, columns: list[str], uneven: str, place_name: str, options: dict[str, str]) -> DataFrame:
    """Fields of records under the header's names and their place; ``uneven`` is the text of a record with another number
    of fields. The first record of every file must be the header."""
    names = ", ".join(f"`{c}` string" for c in (*columns, uneven))
    fields = F.from_csv("record", names, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": uneven})
    rows = found.withColumn("_fields", fields).where(_is_row(columns, uneven))
    place = F.struct("file", "block", "row").alias(place_name)
    return rows.select(*[F.col(f"_fields.`{c}`").alias(c) for c in (*columns, uneven)], place)


def _is_row(columns: list[str], uneven: str) -> Column:
    same = F.col(f"_fields.`{uneven}`").isNull()
    for c in columns:
        same = same & (F.lower(F.col(f"_fields.`{c}`")) == c.lower())
    other = F.raise_error(F.concat(F.lit("another header than the first file: "), "file")).cast("boolean")
    return F.when(~F.col("first"), True).when(same, False).otherwise(other)
