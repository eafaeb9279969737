r"""Records of delimited files, read in ranges even where quoted fields span lines, and numbered.

Whether a line begins inside a quoted field depends on all lines before it, but only as one of two states. So every line is a small
function: the state after it if it begins outside a quoted field, and if it begins inside one. A range of a
file is read in order by one task, which composes these functions along it; the ranges of a file, of which there are few, are
composed by a window over one short row each. Then every range knows in which state it begins, how many records and lines lie before it, and all
ranges are parsed at once, each record put together where its lines are read. Only lines of records that go over a range's end meet by a shuffle.

Lines end at ``\n``; a carriage return before it is dropped at the end of a record and kept inside a quoted field.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rollbook.functions.text import percent_decode
from rollbook.session import work_dir

# The functions below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lines that a record may have in ranges where no other record begins: beyond it a quote was left open by mistake.
MAX_LINES = 100_000


class UnclosedQuote(ValueError):
    """A quoted field that swallows whole ranges of its file."""


@dataclass(frozen=True)
class Form:
    """How fields are separated and characters encoded; quotes are doubled inside a quoted field."""

    sep: str
    encoding: str

    @property
    def open_end(self) -> str:
        """Lines that begin outside a quoted field and end inside one."""
        return f"(?s)^{self._fields}{_OPEN}$"

    @property
    def stays_open(self) -> str:
        """Lines that begin inside a quoted field and end inside one: that one, or another."""
        return f'(?s)^{_TO_QUOTE}(?:"[^{self.sep}]*+{self.sep}{self._fields}{_OPEN})?$'

    @property
    def _fields(self) -> str:
        s = self.sep
        return f'(?:(?:{_OPEN}"[^{s}]*+|[^"{s}][^{s}]*+)?{s})*+'

    @property
    def options(self) -> dict[str, str]:
        return {"sep": self.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


# Possessive, so that long lines need no stack.
_TO_QUOTE = '[^"]*+(?:""[^"]*+)*+'
_OPEN = f'"{_TO_QUOTE}'

#: The published raw files, and headered exports.
RAW, HEADERED = Form(";", "ISO-8859-1"), Form(",", "UTF-8")


def raw_lines(spark: SparkSession, paths: Sequence[str], form: Form = RAW) -> DataFrame:
    """(file, block, at, text): lines with the range of the file they begin in, in order; ``at`` grows by one along a range.

    ``file`` is the path as Spark writes it: it is decoded once a range, not once a line.
    """
    value = F.col("value")
    text = value if form.encoding == "UTF-8" else F.decode(value.cast("binary"), form.encoding)
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), text.alias("text"),
    )


_RANGE = ["file", "block"]
_BLANKS = "".join(map(chr, range(33)))


def is_blank(text: Column) -> Column:
    return F.ltrim(text, F.lit(_BLANKS)) == ""


def _without_return(text: Column) -> Column:
    return F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)


def _functions(lines: DataFrame, form: Form) -> DataFrame:
    """``lines`` with the state each ends in if it begins outside a quoted field (``opens``) or inside one (``stays``)."""
    quoted = F.col("text").contains('"')
    # The pattern is tried where a field begins with a quote: without one, none is opened.
    first = F.col("text").startswith('"') | F.col("text").contains(f'{form.sep}"')
    return lines.withColumns({
        "opens": F.when(first, F.col("text").rlike(form.open_end)).otherwise(False),
        "stays": F.when(quoted, F.col("text").rlike(form.stays_open)).otherwise(True),
    })


def _states(opens: np.ndarray, stays: np.ndarray, begin: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line begins, and ends, inside a quoted field, if the first of them begins as ``begin`` says.

    The last line that ends in one state whatever it began in settles it; each line since that turns the state round counts.
    """
    flips = np.cumsum(opens & ~stays) % 2 == 1
    last = np.maximum.accumulate(np.where(opens == stays, np.arange(len(opens)), -1))
    after = np.where(last >= 0, opens[last] ^ flips[last], begin) ^ flips
    return np.concatenate(([begin], after[:-1])), after


def _stretches(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of each stretch of rows that are alike in ``columns``."""
    size = len(columns[0])
    new = np.zeros(max(size - 1, 0), bool)
    for column in columns:
        new |= column[1:] != column[:-1]
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), size]
    return zip(cuts[:-1], cuts[1:]) if size else iter(())


_COUNTS = ("records", "blank", "end", "head", "tail")
_COUNTED = "file string, block bigint, first_at bigint, lines bigint, " + ", ".join(f"{c}_{k} bigint" for k in (0, 1) for c in _COUNTS)


def _count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range with what it holds if it begins outside (``_0``) or inside a quoted field (``_1``).

    ``head`` lines belong to a record that began before it, those from line ``tail`` on to one that goes on after it.
    """
    now: dict | None = None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{**now["range"], **{f"{c}_{k}": int(now[k][c]) for k in (0, 1) for c in _COUNTS}}], schema=schema)

    kinds = [("file", pa.string()), *((n.split(" ")[0], pa.int64()) for n in _COUNTED.split(", ")[1:])]
    schema = pa.schema(kinds)
    for batch in batches:
        files, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        codes = files.indices.to_numpy()
        blank, opens, stays = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5))
        for lo, hi in _stretches(codes, block):
            file, start = files.dictionary[codes[lo]].as_py(), int(block[lo])
            if now is None or (now["range"]["file"], now["range"]["block"]) != (file, start):
                if now:
                    yield row()
                now = {"range": {"file": file, "block": start, "first_at": batch.column(2)[lo].as_py(), "lines": 0}}
                now |= {k: {"records": 0, "blank": 0, "end": k, "head": 0, "tail": 0} for k in (0, 1)}
            before = now["range"]["lines"]
            for k in (0, 1):
                inside, after = _states(opens[lo:hi], stays[lo:hi], bool(now[k]["end"]))
                starts = np.flatnonzero(~inside)
                if not now[k]["records"]:
                    now[k]["head"] += int(starts[0]) if len(starts) else hi - lo
                if len(starts):
                    now[k]["tail"] = before + int(starts[-1])
                now[k]["records"] += len(starts)
                now[k]["blank"] += int(np.count_nonzero(blank[lo:hi] & ~inside))
                now[k]["end"] = int(after[-1])
            now["range"]["lines"] += hi - lo
    if now:
        yield row()


def file_ranges(lines: DataFrame, form: Form = RAW, spans: bool = True) -> DataFrame:
    """One row per range: state at its begin, lines and records before it in its file, its lines, records and blank lines,
    the lines at its begin that go on with a record (``head``) and the place from which lines go on after it (``tail``).

    ``spans`` False is for files in which no field spans lines: lines are records.
    """
    blank = is_blank(F.col("text"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("lines", "records")}
    path = percent_decode(F.col("file")).alias("path")
    if not spans:
        found = lines.groupBy(*_RANGE).agg(F.min("at").alias("first_at"), F.count("*").alias("lines"), F.count_if(blank).alias("blank_lines"))
        return found.withColumn("records", F.col("lines")).withColumn("begin", F.lit(0)).withColumns(sums).select("*", path)
    # The text stays behind, and nothing but a row for each range leaves its task.
    found = _functions(lines, form).select(*_RANGE, "at", blank.alias("blank"), "opens", "stays").mapInArrow(_count_ranges, _COUNTED)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    settles = F.col("end_0") == F.col("end_1")
    found = found.withColumn("flips", F.sum(F.when(settles, 0).otherwise(F.col("end_0"))).over(upto))
    found = found.withColumn("fixed", F.last(F.when(settles, (F.col("end_0") + F.col("flips")) % 2), ignorenulls=True).over(upto))
    after = (F.coalesce(F.col("fixed"), F.lit(0)) + F.col("flips")) % 2
    found = found.withColumn("after", after).withColumn("begin", F.coalesce(F.lag("after").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    for name in _COUNTS:
        found = found.withColumn(name, F.when(F.col("begin") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1")))
    found = found.withColumn("tail", F.when(F.col("end") == 1, F.col("tail")).otherwise(F.col("lines")))
    found = found.withColumnRenamed("blank", "blank_lines").withColumns(sums)
    return found.select(*_RANGE, path, "first_at", "begin", "lines", "records", "blank_lines", "lines_before", "records_before", "head", "tail")


def settled_ranges(lines: DataFrame, form: Form = RAW, spans: bool = True) -> DataFrame:
    """The ranges, written; :class:`UnclosedQuote` where one record takes ``MAX_LINES`` lines or more of ranges that it has to itself."""
    spark, path = lines.sparkSession, work_dir(lines.sparkSession, "file-ranges")
    found = file_ranges(lines, form, spans)
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    open_ = found.filter("begin = 1 AND records = 0").groupBy("path", "records_before").agg(F.sum("lines").alias("lines"))
    bad = open_.filter(F.col("lines") >= MAX_LINES).orderBy("path", "records_before").first()
    if bad:
        raise UnclosedQuote(f"{bad['path']}: record {bad['records_before']} has {bad['lines']} lines or more, a quote may not be closed")
    return found


_WHOLE = "range bigint, record bigint, line bigint, text string"


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in their range, put together from its lines; record and line count from 1 in the range.

    Lines before the first record of the range, and those of one that does not end in it, are left out.
    """
    part, inside, lines, count, held, first = None, False, 0, 0, [], 0
    for batch in batches:
        ranges, begin, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).cast(pa.string())
        opens, stays = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
        for lo, hi in _stretches(ranges):
            if ranges[lo] != part:
                part, inside, lines, count, held = ranges[lo], bool(begin[lo]), 0, 0, []
            before, after = _states(opens[lo:hi], stays[lo:hi], inside)
            starts, inside = np.flatnonzero(~before), bool(after[-1])
            ends = np.append(starts[1:], hi - lo) if len(starts) else starts
            numbers, at, found = count + 1 + np.arange(len(starts)), lines + 1 + starts, []
            # What an earlier batch began goes on up to the first record that begins here.
            upto = int(starts[0]) if len(starts) else hi - lo
            if held and upto:
                held.append(texts.slice(lo, upto))
            if held and (len(starts) or not inside):
                found.append((pa.array([count]), pa.array([first]), pa.array(["\n".join(t for piece in held for t in piece.to_pylist())])))
                held = []
            if len(starts) and inside:
                held, first = [texts.slice(lo + int(starts[-1]), hi - lo - int(starts[-1]))], int(at[-1])
                starts, ends, numbers, at = starts[:-1], ends[:-1], numbers[:-1], at[:-1]
                count += 1
            count += len(starts)
            lines += hi - lo
            if len(starts):
                offsets = pa.array(np.append(starts, ends[-1]), pa.int32())
                pieces = pa.ListArray.from_arrays(offsets, texts.slice(lo, hi - lo))
                joined = texts.slice(lo + int(starts[0]), len(starts)) if len(starts) == ends[-1] - starts[0] else pc.binary_join(pieces, "\n")
                found.append((pa.array(numbers), pa.array(at), joined))
            for number, line, text in found:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(number), part)), number, line, text], names=["range", "record", "line", "text"])


def records(lines: DataFrame, ranges: DataFrame, form: Form = RAW, spans: bool = True) -> DataFrame:
    """(path, record, line, text) of every record that is not a blank line; records and lines count from 1 in their file.

    Blank lines have numbers, too. ``line`` is the record's first. The ranges, one short row for each split of a file, are broadcast, so that
    lines reach their task in the order they are read.
    """
    number = F.col("at") - F.col("first_at") + F.col("lines_before") + 1
    if not spans:
        found = lines.join(ranges, _RANGE).filter(~is_blank(F.col("text")))
        return found.select("path", number.alias("record"), number.alias("line"), _without_return(F.col("text")).alias("text"))
    known = F.broadcast(ranges.withColumn("range", F.xxhash64(*_RANGE)))
    # Nothing but a number and the state goes with the text: what else is known of a range is joined to its records.
    begun = _functions(lines, form).withColumn("range", F.xxhash64(*_RANGE)).join(known.select("range", "begin"), "range")
    whole = begun.select("range", "begin", "text", "opens", "stays").mapInArrow(_whole_records, _WHOLE).filter(~is_blank(F.col("text")))
    whole = whole.join(known.select("range", "path", "lines_before", "records_before"), "range").select(
        "path", (F.col("record") + F.col("records_before")).alias("record"), (F.col("line") + F.col("lines_before")).alias("line"), "text"
    )
    place = F.col("at") - F.col("first_at")
    over = lines.join(known.drop("range"), _RANGE).filter((place < F.col("head")) | (place >= F.col("tail")))
    record = F.col("records_before") + F.when(place < F.col("head"), 0).otherwise(F.col("records"))
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda p: p["text"]), "\n")
    over = over.select("path", record.alias("record"), number.alias("line"), "text").groupBy("path", "record").agg(F.min("line").alias("line"), pieces.alias("text"))
    return whole.unionByName(over.select("path", "record", "line", "text")).withColumn("text", _without_return(F.col("text")))


def parsed(found: DataFrame, schema: T.StructType, form: Form = RAW) -> DataFrame:
    """``found`` with its text as the columns of ``schema``: short records are padded with nulls, long ones cut."""
    rest = [c for c in found.columns if c != "text"]
    row = F.from_csv("text", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), form.options)
    return found.select(*rest, row.alias("row")).select(*rest, *[F.col(f"row.`{f.name}`") for f in schema.fields])
