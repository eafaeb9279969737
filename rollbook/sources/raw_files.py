"""Delimited files: headerless positional drops, and headered exports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollbook.functions.text import file_name, is_present, percent_decode, strip_whitespace
from rollbook.sources import records
from rollbook.sources.registry import LAYOUTS, Layout

# Encoding, separator and quoting of the published files.
RAW_OPTIONS = {"encoding": "ISO-8859-1", "sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name and size of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return files.select("path", file_name(F.col("path")).alias("name"), "length")


def match_sources(files: DataFrame, layouts: Iterable[Layout] = tuple(LAYOUTS.values())) -> DataFrame:
    """(table, path, name, length) of every file whose name holds one of a table's aliases, in any case."""
    lower = F.lower("name")
    tables = []
    for layout in layouts:
        hit = reduce(lambda a, b: a | b, [lower.contains(alias.lower()) for alias in layout.aliases])
        tables.append(F.when(hit, F.lit(layout.name)))
    return files.filter(~F.col("name").endswith(".tmp")).select(
        F.explode(F.array_compact(F.array(*tables))).alias("table"), *files.columns
    )


def raw_profile(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file (``path`` in full): physical lines, blank lines, and lines with an odd number of quotes.

    A file without an odd line holds no quoted line break, so its lines are its records.
    """
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return (
        spark.read.text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.when(F.col("value").contains('"'), quotes % 2 == 1).otherwise(False).alias("odd"),
            records.is_blank(F.col("value")).alias("blank"),
        )
        .groupBy("file")
        .agg(
            F.count("*").alias("lines"),
            F.count_if("blank").alias("blank_lines"),
            F.count_if("odd").alias("odd_quote_lines"),
        )
        .select(percent_decode(F.col("file")).alias("path"), "lines", "blank_lines", "odd_quote_lines")
    )


def files_by_reader(profile: DataFrame) -> dict[bool, list[str]]:
    """Paths of a drop's files: True those that hold quoted line breaks, False the others.

    One short row per file. A file without a line has no row here, and none for a reader either.
    """
    found: dict[bool, list[str]] = {True: [], False: []}
    for row in profile.select("path", (F.col("odd_quote_lines") > 0).alias("quoted")).orderBy("path").collect():
        found[row["quoted"]].append(row["path"])
    return found


def scan_raw(
    spark: SparkSession, paths: Sequence[str], layout: Layout, multi_line: bool | dict[bool, list[str]] | None = None,
    with_source: bool = False,
) -> DataFrame:
    """Several headerless part files, or folders of them, as one table of text columns.

    Short rows are padded with nulls and long rows cut. Quoted line breaks need the reader of records, which
    reads a file in ranges too, but reads it more than once. ``multi_line`` says where to use it: everywhere, nowhere, or by file
    (``files_by_reader``); None looks for those files first.
    """
    if multi_line is None:
        multi_line = files_by_reader(raw_profile(spark, paths))
    if isinstance(multi_line, bool):
        multi_line = {multi_line: sorted(paths)}
    elif not multi_line.get(True):
        multi_line = {False: sorted(paths)}
    frames = []
    for whole, members in multi_line.items():
        if not members:
            continue
        if whole:
            frame = numbered_rows(spark, members, layout).select(*layout.columns, *(["source_path"] if with_source else []))
        else:
            frame = spark.read.schema(layout.schema).options(**RAW_OPTIONS).csv(members)
            if with_source:
                frame = frame.select("*", percent_decode(F.col("_metadata.file_path")).alias("source_path"))
        frames.append(frame)
    return reduce(DataFrame.unionByName, frames)


def numbered_rows(spark: SparkSession, paths: Sequence[str], layout: Layout, spans: bool = True, ranges: DataFrame | None = None) -> DataFrame:
    """The rows of headerless files with ``source_path``, the ``record`` and the ``line`` they begin at in it, both from 1.

    ``spans`` False is for files in which no field spans lines (``files_by_reader``): their lines are their records.
    ``ranges`` are those of the same files, where they are known.
    """
    lines = records.raw_lines(spark, paths)
    if ranges is None:
        ranges = records.settled_ranges(lines, spans=spans)
    rows = records.parsed(records.records(lines, ranges, spans=spans), layout.schema)
    return rows.withColumnRenamed("path", "source_path").select("source_path", "record", "line", *layout.columns)


def scan_counted(spark: SparkSession, paths: Sequence[str], layout: Layout, multi_line: bool | dict[bool, list[str]] | None = None) -> tuple[DataFrame, int]:
    """:func:`scan_raw`, and the number of the files' blank lines: never rows, whatever the reader."""
    if isinstance(multi_line, bool):
        multi_line = {multi_line: sorted(paths)}
    profile = raw_profile(spark, paths)
    # One short row per file.
    found = profile.select("path", "blank_lines", (F.col("odd_quote_lines") > 0).alias("quoted")).orderBy("path").collect()
    if multi_line is None:
        multi_line = {quoted: [r["path"] for r in found if r["quoted"] == quoted] for quoted in (True, False)}
    spanning = multi_line.get(True) or []
    if not spanning:
        return scan_raw(spark, paths, layout, {False: sorted(paths)}), sum(r["blank_lines"] for r in found)
    ranges = records.settled_ranges(records.raw_lines(spark, spanning))
    counted = ranges.groupBy("path").agg(F.sum("blank_lines")).collect()
    blank = sum(r[1] for r in counted) + sum(r["blank_lines"] for r in found if r["path"] not in {c["path"] for c in counted})
    rows = numbered_rows(spark, spanning, layout, ranges=ranges).select(*layout.columns)
    if multi_line.get(False):
        rows = rows.unionByName(scan_raw(spark, multi_line[False], layout, False))
    return rows, blank


def blank_key_lines(spark: SparkSession, paths: Sequence[str], layout: Layout, column: str) -> DataFrame:
    """Rows whose key column is blank, with file, ``record`` and ``line`` as a report names them. An empty row counts, a blank line does not."""
    return numbered_rows(spark, paths, layout).filter(~is_present(strip_whitespace(F.col(column))))


def first_blank_key_lines(spark: SparkSession, paths: Sequence[str], layout: Layout, column: str, samples: int = 5) -> DataFrame:
    """The first few of them by file and record."""
    return blank_key_lines(spark, paths, layout, column).orderBy("source_path", "record").limit(samples)


def write_raw(df: DataFrame, path: str) -> None:
    """Write text columns in the published raw form (used to build drops from other tables)."""
    df.write.mode("overwrite").options(
        encoding="ISO-8859-1", sep=";", quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def scan_headered(spark: SparkSession, paths: str | Sequence[str], multi_line: bool | None = None) -> DataFrame:
    """UTF-8 comma-separated files with a header row; columns are named by the header, all text.

    Files in which quoted fields span lines are read by records, in ranges like all others; ``multi_line`` says whether there are any,
    None looks. The files' headers are the same.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    plain = spark.read.options(header=True, encoding="UTF-8", sep=",", quote='"', escape='"')
    if multi_line is None:
        multi_line = not raw_profile(spark, paths).filter("odd_quote_lines > 0").isEmpty()
    if not multi_line:
        return plain.csv(paths)
    lines = records.raw_lines(spark, paths, records.HEADERED)
    found = records.records(lines, records.settled_ranges(lines, records.HEADERED), records.HEADERED)
    # The first record that is not blank, one short text for each file.
    first = found.filter(F.col("record") == 1).agg(F.min("text")).first()[0]
    if first is None:
        return plain.csv(paths)
    wide = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(first.count(",") + 1)])
    row = records.parsed(spark.range(1).select(F.lit(first).alias("text")), wide, records.HEADERED).first()
    names = [c for c in row if c is not None]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return records.parsed(found.filter(F.col("record") > 1), schema, records.HEADERED).select(*[f"`{n}`" for n in names])


def write_headered(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, encoding="UTF-8", sep=",", quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
