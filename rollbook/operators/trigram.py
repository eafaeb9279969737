"""Substring search through a side table of three-letter pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.text import contains_ci


def trigrams(c: Column) -> Column:
    """Distinct three-letter pieces of the lower-cased text; none for shorter text.

    One scan of the text: the pattern matches between letters and looks ahead for the next three.
    """
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("(?s)(?=(...))"), F.lit(1)))


def build_index(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(field, trigram, key), each once per row. No shuffle: pieces are made distinct within their row."""
    per_field = F.explode(
        F.array(*[F.struct(F.lit(c).alias("field"), trigrams(F.col(c)).alias("pieces")) for c in columns])
    )
    return (
        df.select(key, per_field.alias("f"))
        .select("f.field", key, F.explode("f.pieces").alias("trigram"))
        .select("field", "trigram", key)
    )


def build_name_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, trigram, rows, name): the pieces of each different name of a field, and how many rows have the name.

    Companies share their names with all their branches, and trade names are few: names are made distinct, combined before the
    shuffle, and only then cut into pieces.
    """
    per_field = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("name")) for c in columns]))
    names = df.select(per_field.alias("f")).select("f.*").filter("name IS NOT NULL").groupBy("field", "name").agg(F.count("*").alias("rows"))
    return names.select("field", F.explode(trigrams(F.col("name"))).alias("trigram"), "rows", "name")


def write_index(index: DataFrame, path: str) -> None:
    """Write sorted by piece, so that a search reads few row groups.

    Ranges include the key (last column): a piece that a third of all rows share spans several of them.
    """
    key = index.columns[-1]
    index.repartitionByRange("field", "trigram", key).sortWithinPartitions("field", "trigram", key).write.mode(
        "overwrite"
    ).parquet(path)


def usable(text: str) -> bool:
    """Whether the side table can answer: three letters or more and no wildcard."""
    return len(text) >= 3 and not set(text) & set("%_\\")


def search_indexed(
    df: DataFrame, index: DataFrame, key: str, columns: Sequence[str], text: str
) -> DataFrame:
    """Rows in which one of ``columns`` contains ``text`` in any case; the same answer as a scan.

    Candidates hold every piece of the text in one field; the text itself is then checked again. One lazy plan
    at every size: Spark broadcasts a short list of candidates and merges a long one.
    """
    condition = None
    for c in columns:
        part = contains_ci(F.col(c), text)
        condition = part if condition is None else condition | part
    if not usable(text):
        return df.filter(condition)
    lower = text.lower()
    pieces = sorted({lower[i:i + 3] for i in range(len(lower) - 2)})
    candidates = (
        index.filter(F.col("field").isin(*columns) & F.col("trigram").isin(*pieces))
        .groupBy(key, "field")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") == len(pieces))
        .select(key)
    )
    return df.filter(condition).join(candidates, key, "left_semi")


def search_names(df: DataFrame, index: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """:func:`search_indexed` by an index of names: the names that hold every piece are looked up in the columns."""
    condition = None
    for c in columns:
        part = contains_ci(F.col(c), text)
        condition = part if condition is None else condition | part
    if not usable(text):
        return df.filter(condition)
    lower = text.lower()
    pieces = sorted({lower[i:i + 3] for i in range(len(lower) - 2)})
    names = index.filter(F.col("trigram").isin(*pieces)).groupBy("field", "name").agg(F.count("*").alias("n")).filter(F.col("n") == len(pieces))
    found, hit = df.filter(condition), F.lit(False)
    for k, c in enumerate(columns):
        known = names.filter(F.col("field") == c).select(F.col("name").alias(f"__name{k}"))
        found = found.join(known, F.col(c) == F.col(f"__name{k}"), "left")
        hit = hit | F.col(f"__name{k}").isNotNull()
    return found.filter(hit).select(*df.columns)


def piece_counts(index: DataFrame) -> DataFrame:
    """(field, trigram, rows): how many rows have a piece. It is kept with the index, so that a search knows its rarest piece."""
    return index.groupBy("field", "trigram").agg(F.count("*").alias("rows"))


#: Posting lists are met from the rarest on, up to lists so many times as long; the text itself is checked at the end.
WORTH_MEETING = 20


def meet(index: DataFrame, counts: DataFrame, key: str, columns: Sequence[str], text: str, most: int | None = None) -> DataFrame | None:
    """Keys of rows that may contain ``text`` in one of ``columns``: their posting lists met by semi joins, rarest first.

    ``index`` and ``counts`` are those of the same rows. A row that contains the text is always among them. None where the
    index does not help: the text has no piece (:func:`usable`), or its rarest one is in more than ``most`` rows.
    """
    if not usable(text):
        return None
    lower = text.lower()
    pieces = sorted({lower[i:i + 3] for i in range(len(lower) - 2)})
    # At most one short row for each piece of the text and field.
    known = {(r["field"], r["trigram"]): r["rows"] for r in counts.filter(F.col("field").isin(*columns) & F.col("trigram").isin(*pieces)).collect()}
    found = None
    for c in columns:
        if any((c, p) not in known for p in pieces):
            continue  # no row has them all
        ordered = sorted(pieces, key=lambda p: (known[c, p], p))
        rarest = known[c, ordered[0]]
        if most is not None and rarest > most:
            return None
        lists = [index.filter((F.col("field") == c) & (F.col("trigram") == p)).select(key) for p in ordered if known[c, p] <= WORTH_MEETING * rarest]
        met = lists[0]
        for other in lists[1:]:
            met = met.join(other, key, "left_semi")
        found = met if found is None else found.unionByName(met)
    return index.select(key).limit(0) if found is None else found.distinct()
