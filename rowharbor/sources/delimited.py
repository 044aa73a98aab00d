"""Delimited files: scan, header, record numbers, samples and previews.

A scan keeps three source columns beside the data: the file, the byte offset of the split the
record was read from, and a position that grows inside a split. They cost nothing and order the
records of one file; running record numbers are worked out from them only where a report asks.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowharbor.control import NO_QUOTE, FileControl
from rowharbor.runtime import field, join_splits, materialise

SRC_FILE = "_src_file"
SRC_BLOCK = "_src_block"
SRC_POS = "_src_pos"
SRC_TIME = "_src_time"  # of streams only: files count in the order they arrived
CORRUPT = "_corrupt"
RECORD_NO = "record_no"
SOURCE_COLUMNS = (SRC_FILE, SRC_BLOCK, SRC_POS, SRC_TIME, CORRUPT, RECORD_NO)

# A header that has not ended after so many lines has an open quote.
HEADER_LINES = 100_000

# A text no cell holds: keeps the reader from taking any real cell for a null.
_IMPOSSIBLE = "\u0001\u0002null\u0002\u0001"


def placeholder_columns(n: int) -> list[str]:
    """Names for the columns of a file without a header."""
    return [f"column_{i}" for i in range(n)]


def usable_names(columns: Sequence[str]) -> list[str]:
    """Names a scan can use: of equal names, whatever their case, the last one stays; the others,
    and blank ones, become ``column_<i>``."""
    last = {name.lower(): i for i, name in enumerate(columns)}
    spare = placeholder_columns(len(columns))
    names = [
        n if n.strip() and last[n.lower()] == i else spare[i] for i, n in enumerate(columns)
    ]
    taken = {n.lower() for i, n in enumerate(names) if n != spare[i]}
    return [n + "_" if n == spare[i] and n in taken else n for i, n in enumerate(names)]


def data_columns(df: DataFrame) -> list[str]:
    """Columns that came from the file itself, in order."""
    return [c for c in df.columns if c not in SOURCE_COLUMNS and c != "_errors"]


def _separator(control: FileControl) -> str:
    return control.separator or ","


def _quote(control: FileControl) -> str:
    return '"' if control.quote is None else (control.quote or NO_QUOTE)


def reader_options(control: FileControl) -> dict:
    quote = _quote(control)
    return {
        "sep": _separator(control),
        "quote": quote,
        # with no escape character of its own, a doubled quote stands for a quote
        "escape": _own_escape(control) or quote,
        "encoding": control.encoding or "utf-8",
        "multiLine": spans_lines(control),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # pruned columns would hide short and long rows
        "columnPruning": False,
        "enforceSchema": True,
        "nullValue": _IMPOSSIBLE,
        "emptyValue": "",
        "maxCharsPerColumn": -1,
    }


def csv_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])


def leading_records(control: FileControl) -> int:
    """How many records of each file come before the data: those to skip, and a header after
    them. Where the control names the columns, a header counts among the skipped records."""
    if control.columns:
        return max(control.skip, int(control.has_header_row))
    return control.skip + int(control.has_header_row)


def spans_lines(control: FileControl) -> bool:
    """Whether a file cannot be cut at every line break: a cell may hold one, unless there is no
    quoting, or a character takes several bytes."""
    wide = _charset(control).startswith(("utf-16", "utf-32"))
    return wide or (control.multi_line and _quote(control) != NO_QUOTE)


def _charset(control: FileControl) -> str:
    return (control.encoding or "utf-8").lower().replace("_", "-")


def _own_escape(control: FileControl) -> str | None:
    """The escape character, where it is not the quote itself."""
    escape = (control.escape or "")[:1]
    return None if escape in ("", NO_QUOTE, _quote(control)) else escape


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    control: FileControl,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """All records of a file or folder of files, every cell as text.

    Column names come from ``names``, the control, or the file's own header. Cells beyond the
    names are dropped and short rows are filled with nulls; both are kept in ``_corrupt``.

    ``multi_line=False`` promises that no quoted cell holds a line break, so that files are split
    by lines. Otherwise one task reads a whole file, whatever its size: hand over such exports in parts.

    Where the names come from the header of a folder's first file, all files must have that header,
    but for case: the scan fails on a file whose columns differ.
    """
    named = names or control.columns
    header = [] if named else _first_header(spark, path, control)
    names = usable_names(named or [h.strip() for h in header])
    lead = leading_records(control)
    shared = None  # the header that several files have to share
    if not named and control.has_header_row and len(_listing(spark, path).head(2)) > 1:
        shared = header
    spelt = names
    if shared and lead == 1:
        spelt = _reader_header(spark, path, control) or names
    # the reader itself compares each file's header, unless a name stands in it twice
    compared = shared is None or spelt is not names
    read = (
        spark.read.schema(csv_schema(spelt))
        .options(**reader_options(control))
        .options(header=lead == 1 and compared, enforceSchema=shared is None)
        .csv(path)
    )
    df = _with_source(read, [*names, CORRUPT])
    if lead > 1 or not compared:
        fits = _is_header([field(n) for n in names], F.col(CORRUPT), shared) if shared else None
        df = drop_leading(df, lead, fits)
    return df


def _is_header(cells: Sequence[Column], corrupt: Column, header: Sequence[str]) -> Column:
    """Whether these cells are a header's, but for case; not where some are missing or too many."""
    fits = corrupt.isNull()
    for cell, name in zip(cells, header):
        fits = fits & (F.lower(F.coalesce(cell, F.lit(""))) == name.lower())
    return fits


def _differs(file: Column) -> Column:
    text = F.concat(F.lit("the header differs from that of the first file: "), file)
    return F.raise_error(text).cast("boolean")


def _reader_header(
    spark: SparkSession, path: str | list[str], control: FileControl
) -> list[str] | None:
    """The first file's header as the reader spells it; None where names repeat."""
    first = _listing(spark, path).agg(F.min("path")).first()[0]
    head = spark.read.options(**reader_options(control)).option("header", False).csv(first).first()
    spelt = [_IMPOSSIBLE if cell is None else cell for cell in head or ()]
    return spelt if len({s.lower() for s in spelt}) == len(spelt) else None


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path")


def _with_source(read: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return read.select(
        *[field(c).alias(n) for c, n in zip(read.columns, names or read.columns)],
        F.col("_metadata.file_path").alias(SRC_FILE),
        F.col("_metadata.file_block_start").alias(SRC_BLOCK),
        F.monotonically_increasing_id().alias(SRC_POS),
    )


def read_header(spark: SparkSession, path: str | list[str], control: FileControl) -> list[str]:
    """Names of the file's columns: the record after ``skip`` records, cells trimmed."""
    return [h.strip() for h in _first_header(spark, path, control)]


def _first_header(spark: SparkSession, path: str | list[str], control: FileControl) -> list[str]:
    """The header as it stands in the file.

    Records are counted, not lines. Of a folder, the first file by name is looked at; only its
    leading lines reach the driver.
    """
    first = _listing(spark, path).agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no file below {path}")
    want = control.skip
    take = max(64, 4 * (want + 1))
    while True:
        got = _first_lines(spark, first, control, take)
        records = _records(got, control, complete=len(got) < take)
        if len(records) > want or len(got) < take:
            break
        if take > HEADER_LINES:
            raise ValueError(f"no header within the first {take} lines of {first}")
        take *= 4
    header = records[want] if len(records) > want else []
    if not control.has_header_row:
        return placeholder_columns(len(header))
    if header and want == 0:
        header = [header[0].removeprefix("﻿"), *header[1:]]
    return header


def _first_lines(spark: SparkSession, path: str, control: FileControl, n: int) -> list[str]:
    """Leading physical lines of one file."""
    if _charset(control).startswith(("utf-16", "utf-32")):
        # one column that takes whole lines: no separator or quote can occur
        whole = (
            spark.read.schema("value string")
            .options(sep="\u0001", quote=NO_QUOTE, encoding=control.encoding, multiLine=True)
            .csv(path)
        )
        return [r[0] or "" for r in whole.limit(n).collect()]
    encoding = control.encoding or "utf-8"
    lines = spark.read.text(path).select(F.col("value").cast("binary"))
    return [bytes(r[0]).decode(encoding) for r in lines.limit(n).collect()]


def _records(lines: list[str], control: FileControl, complete: bool) -> list[list[str]]:
    """Leading records of a file; the last one is dropped where more lines may belong to it."""
    quote = _quote(control)
    escape = _own_escape(control)
    reader = csv.reader(
        (line + "\n" for line in lines),
        delimiter=_separator(control),
        quotechar=None if quote == NO_QUOTE else quote,
        quoting=csv.QUOTE_NONE if quote == NO_QUOTE else csv.QUOTE_MINIMAL,
        doublequote=escape is None,
        escapechar=escape,
    )
    records = list(reader)
    return records if complete else records[:-1]


def with_record_no(
    df: DataFrame,
    staged: bool = False,
    whole_folder: bool = False,
    only: Column | None = None,
) -> DataFrame:
    """Running number of each data record, from 0, inside its file; or, for a folder whose files
    are the parts of one export, inside the folder, files taken in name order.

    Nothing is sorted: one small row per split (first position, count) is summed up and joined
    back. The scan is written to scratch space first (``staged`` says that it has been already),
    so that both passes see the same splits even when executors come and go. ``only`` picks the
    rows that are wanted with their number; all are counted.
    """
    kept = df if staged else materialise(df, "records")
    at = [SRC_FILE, SRC_BLOCK]
    splits = materialise(
        kept.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), F.min(SRC_POS).alias("_first")),
        "splits",
    )
    if whole_folder:
        # part-100000 follows part-99999
        within = F.regexp_extract(SRC_FILE, r"^(.*)/", 1)
        order = [F.length(SRC_FILE), F.col(SRC_FILE), F.col(SRC_BLOCK)]
    else:
        within, order = F.col(SRC_FILE), [F.col(SRC_BLOCK)]
    # a window over one row per split, not per record
    earlier = Window.partitionBy(within).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = splits.select(
        *at, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    wanted = kept if only is None else kept.filter(only)
    joined = join_splits(wanted, materialise(shift, "shift"), at)
    return joined.select(
        *[field(c) for c in kept.columns], (F.col(SRC_POS) + F.col("_shift")).alias(RECORD_NO)
    )


def with_position(staged: DataFrame, name: str) -> DataFrame:
    """Adds the place of each record among all records of a staged scan, files in the order of their
    times and names: one number, so that the last of several records is found without sorting."""
    order = [c for c in (SRC_TIME, SRC_FILE, SRC_BLOCK) if c in staged.columns]
    at = [SRC_FILE, SRC_BLOCK]
    times = [F.min(SRC_TIME).alias(SRC_TIME)] if SRC_TIME in order else []
    splits = materialise(
        staged.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), F.min(SRC_POS).alias("_first"), *times), "splits"
    )
    # a window over one row per split, not per record
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    shift = splits.select(
        *at, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    joined = join_splits(staged, materialise(shift, "shift"), at)
    return joined.select(*[field(c) for c in staged.columns], (F.col(SRC_POS) + F.col("_shift")).alias(name))


def drop_leading(df: DataFrame, lead: int, check: Column | None = None) -> DataFrame:
    """The scan without the first ``lead`` records of each file.

    They stand in a file's first split, so one small row per file, of where that split begins, is all
    that is joined: the records themselves are not staged. Spark plans the splits of a listing alike each time.
    Where a first split holds fewer records, all records are numbered. ``check`` looks at each last leading
    record, and fails the scan unless it is true.
    """
    first = df.filter(F.col(SRC_BLOCK) == 0)
    heads = materialise(
        first.groupBy(SRC_FILE).agg(F.min(SRC_POS).alias("_first"), F.count(F.lit(1)).alias("_n")), "heads"
    )
    if heads.filter(F.col("_n") <= lead).isEmpty():
        met = join_splits(df, heads, [SRC_FILE]).withColumn("_at", F.when(F.col(SRC_BLOCK) == 0, F.col(SRC_POS) - F.col("_first")))
    else:
        met = with_record_no(df).withColumnRenamed(RECORD_NO, "_at")
    leads = F.coalesce(F.col("_at") < lead, F.lit(False))
    if check is not None:
        leads = F.when((F.col("_at") == lead - 1) & ~check, _differs(F.col(SRC_FILE))).otherwise(leads)
    return met.filter(~leads).select(*[field(c) for c in df.columns])


def blank_row(columns: Sequence[str]) -> Column:
    """True for a record with nothing in any cell."""
    empty = F.lit(True)
    for name in columns:
        empty = empty & (F.coalesce(field(name), F.lit("")) == "")
    return empty


def mark_blank_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines of single-line files with a ``blank`` flag; the delimited reader itself
    leaves blank lines out."""
    lines = spark.read.text(path)
    return _with_source(lines).withColumn("blank", F.col("value").rlike(r"^\s*$"))


def scan_head(
    spark: SparkSession, path: str, control: FileControl, n: int = 100
) -> DataFrame:
    """First ``n`` records of a file, or of a folder's files in name order, with their numbers.

    Files are opened one by one until there are enough records, and only the splits that are
    needed are read; the driver holds ``n`` rows at most.
    """
    names = usable_names(control.columns or read_header(spark, path, control))
    listing = _listing(spark, path)
    head: list = []
    look = 4
    done = 0
    while True:
        nearest = listing.orderBy(F.length("path"), "path").limit(look).collect()
        for row in nearest[done:]:
            # splits of one file are taken in order, and the stock reader stops when told to
            rows = scan_delimited(spark, row["path"], control, names).select(
                *[field(c) for c in names]
            )
            head += [tuple(r) for r in rows.take(n - len(head))]
            if len(head) == n:
                break
        done = len(nearest)
        if len(head) == n or done < look:
            break
        look *= 4
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in names] + [T.StructField(RECORD_NO, T.LongType())]
    )
    return spark.createDataFrame([(*r, i) for i, r in enumerate(head)], schema)


def sample_rows(df: DataFrame, n: int = 100, known: Sequence[str] | None = None) -> DataFrame:
    """Some ``n`` rows of a dataset, or of the head of a file, with the columns that are known."""
    keep = [c for c in data_columns(df) if known is None or c in set(known)]
    return df.select(*[field(c) for c in keep]).limit(n)


def column_preview(head: DataFrame, k: int = 10, width: int = 50) -> DataFrame:
    """First ``k`` values of every column as one text, ``N/A`` for a missing cell; takes the head
    of a file."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(name).alias("column_name"),
                F.coalesce(field(name), F.lit("N/A")).alias("value"),
            )
            for i, name in enumerate(data_columns(head))
        ]
    )
    long = head.filter(F.col(RECORD_NO) < k).select(RECORD_NO, F.explode(cells).alias("_cell"))
    ordered = F.array_sort(F.collect_list(F.struct(RECORD_NO, "_cell.value")))  # k values at most
    text = F.array_join(F.transform(ordered, lambda s: s["value"]), ", ")
    return long.groupBy("_cell.pos", "_cell.column_name").agg(
        F.left(text, F.lit(width)).alias("preview")
    )
