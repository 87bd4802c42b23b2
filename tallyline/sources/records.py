"""CSV files with quoted line breaks, read by as many tasks as their size asks for.

Lines are read as text, which splits anywhere. A line break lies within quotes if an odd number of
quote characters comes before it in the file. So each split tells the parity of its quotes, a running
sum over the splits of a file tells how each one begins, and with that every task joins its own lines
to records. What lies across the edge of splits is put together from its pieces, two a split at most.
Spark's own parser then reads the fields of each record.

Lines end with a line feed, or with a carriage return and a line feed if the first line of their file
does; then that pair becomes a line feed within quotes too, as in Spark's own reader. The text is
passed over twice. What is broadcast between the passes is a row a split: 100,000 rows for 100 TiB
with the split size of `session.settings_for`.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.schemas import RAW_COLUMNS, raw_schema

SPLIT = "file string, at long"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, at (where the split begins) and line, in the order of the file within each split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The parts of a batch that come from one split."""
    files = batch.column(0).dictionary_encode()
    file, at = files.indices.to_numpy(), batch.column(1).to_numpy()
    edges = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1 if batch.num_rows else []
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if b > a:
            yield (batch.column(0)[int(a)].as_py(), int(at[a])), batch.slice(a, b - a)


def _quotes_before(lines: pa.Array, parity: int) -> tuple[np.ndarray, int]:
    """The parity of quotes before each line, and that after the last."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(quotes) + parity
    return (total - quotes) & 1, int(total[-1] & 1)


def _tell_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, at, parity of the quotes, whether a record begins in it if the split begins in quotes, and
    whether the first line of the file ends with a carriage return."""
    found: dict[tuple, list] = {}
    for batch in batches:
        for split, part in _runs(batch):
            if split not in found:
                found[split] = [0, False, split[1] == 0 and part.column(2)[0].as_py().endswith("\r")]
            told = found[split]
            before, told[0] = _quotes_before(part.column(2), told[0])
            told[1] = told[1] or bool((before == 1).any())
    rows = [(*split, *told) for split, told in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), TOLD, strict=True)], schema=TOLD)


TOLD = pa.schema([("file", pa.string()), ("at", pa.int64()), ("parity", pa.int32()), ("odd_start", pa.bool_()), ("returns", pa.bool_())])


def _splits(lines: DataFrame) -> DataFrame:
    """file, at, begins (the parity before the split), owner (the split where the record begins that is
    open there) and returns (true if the file's lines end with carriage returns)."""
    told = lines.mapInArrow(_tell_splits, f"{SPLIT}, parity int, odd_start boolean, returns boolean")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.sum("parity").over(Window.partitionBy("file")) % 2 == 1
    begins = (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).cast("int")
    never = F.raise_error(F.concat(F.lit("a quote is never closed in "), "file")).cast("int")
    told = told.withColumn("begins", F.when(odd, never).otherwise(begins))
    starts = F.when((F.col("begins") == 0) | F.col("odd_start"), F.col("at"))
    owner = F.last(starts, ignorenulls=True).over(before)
    return told.select("file", "at", "begins", owner.alias("owner"), F.max("returns").over(Window.partitionBy("file")).alias("returns"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines (file, at, line, begins, owner, returns). The last one of a split, and lines before its
    first, may go on elsewhere: they are pieces, which name the split where their record begins."""
    split, parity, owner, returns, started, open_ = None, 0, None, False, 0, []

    def ended(last: bool) -> list[dict]:
        """What is open, as a record or a piece."""
        if not open_:
            return []
        piece = last or not started
        return [
            {
                "file": split[0],
                "owner": (split[1] if started else owner) if piece else None,
                "at": split[1],
                "record": "\n".join(open_),
                "header": started == 1 and split[1] == 0,
            }
        ]

    for batch in batches:
        out = []
        for now, part in _runs(batch):
            if now != split:
                out += ended(True)
                split, started, open_ = now, 0, []
                parity, owner, returns = (part.column(k)[0].as_py() for k in (3, 4, 5))
                if parity is None:
                    raise ValueError(f"{now[0]} was split anew while it was read")
            before, parity = _quotes_before(part.column(2), parity)
            for line, inside in zip(part.column(2).to_pylist(), before.tolist(), strict=True):
                if not inside:
                    out += ended(False)
                    started, open_ = started + 1, []
                open_.append(line.removesuffix("\r") if returns else line)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=RECORD)
    if out := ended(True):
        yield pa.RecordBatch.from_pylist(out, schema=RECORD)


RECORD = pa.schema(
    [("file", pa.string()), ("owner", pa.int64()), ("at", pa.int64()), ("record", pa.string()), ("header", pa.bool_())]
)


def records(spark: SparkSession, path: str) -> DataFrame:
    """record and header (true for the first one of each file) of a CSV file or a folder of them."""
    lines = _lines(spark, path)
    placed = lines.join(F.broadcast(_splits(lines)), ["file", "at"], "left")
    found = placed.select("file", "at", "line", "begins", "owner", "returns").mapInArrow(_joined, "file string, owner long, at long, record string, header boolean")
    whole = found.where(F.col("owner").isNull()).select("record", "header")
    pieces = found.where(F.col("owner").isNotNull()).groupBy("file", "owner").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "record"))), lambda p: p["record"]), "\n").alias("record"),
        F.max("header").alias("header"),
    )
    both = whole.unionByName(pieces.select("record", "header"))
    return both.where("record <> ''")


def _checked(columns: list[str]):
    """A step that drops headers, which must name the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).filter(batch.column(1)).to_pylist():
                if next(csv.reader([text.removeprefix("\ufeff")]), []) != columns:
                    raise ValueError(f"the header names other columns: {text[:200]}")
            yield batch.select([0]).filter(pc.invert(batch.column(1)))

    return run


def read_records(spark: SparkSession, path: str, table: str) -> DataFrame:
    """As read_csv with multi_line, by many tasks. A record with too few or too many fields fails the
    read, and so does a file whose last quote is open."""
    whole = records(spark, path).mapInArrow(_checked(RAW_COLUMNS[table]), "record string")
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "columnPruning": "false"}
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw_schema(table))
    return whole.select(F.from_csv("record", schema, options).alias("row")).select("row.*")
