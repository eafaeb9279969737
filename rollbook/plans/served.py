"""The serving table as it is published: wide rows by key, and side tables that answer searches without reading them.

All parts are written under one version and published by one line, so that a reader sees parts of one version or none:

* ``serving``: wide rows in folders derived from the base key, sorted by full key, with bloom filters on it. A lookup names its
  folder; base and full keys of a company lie in the same one.
* ``serving_names``, ``serving_pieces``: posting lists of three-letter pieces of the different names, and how many rows have each piece.
* ``serving_name_rows``: the full keys of each name. Names are known by a hash here; a search checks the name itself.
* ``serving_filters``: the narrow columns that searches filter by, in Z-order of activity, municipality and status, so that a
  filter on any one of them skips row groups.
* ``serving_places``: the municipality codes with their descriptions, which turn a search by description into one by codes.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollbook.functions.text import contains_ci
from rollbook.operators import search as S, trigram
from rollbook.operators.zorder import z_ordered
from rollbook.plans.serving import SERVING_COLUMNS
from rollbook.sources.tables import TableFolder

SERVING, NAMES, PIECES, FILTERS, PLACES = "serving", "serving_names", "serving_pieces", "serving_filters", "serving_places"
NAME_ROWS = "serving_name_rows"
KEY = "cnpj_completo"
NAME_COLUMNS = ("razao_social", "nome_fantasia")
Z_COLUMNS = ("cnae_fiscal", "municipio", "situacao_cadastral")
FILTER_COLUMNS = (KEY, "uf", *Z_COLUMNS, "municipio_descricao", "opcao_pelo_simples", "opcao_pelo_mei")
#: Folders of the wide rows. Fixed: readers derive a folder from a key.
KEY_PARTS = 256
#: Bytes of a row group of the narrow columns, the smallest unit that a search skips.
GROUP_BYTES = 8 << 20
#: An index list is used where it holds at most one row in so many; otherwise the search scans.
SELECTIVE = 20
#: Keys fetched at once, and rounds of fetching before candidates are joined instead.
MOST_KEYS, ROUNDS = 4096, 3


def key_part(key: Column) -> Column:
    """The folder of a full key: that of the base key it begins with."""
    return F.pmod(F.crc32(F.substring(key, 1, S.BASE_LENGTH)), F.lit(KEY_PARTS)).cast("int")


def part_of(key: str) -> int:
    """The same, for one full or base key."""
    return zlib.crc32(key[:S.BASE_LENGTH].encode()) % KEY_PARTS


def by_key(wide: DataFrame) -> DataFrame:
    """Wide rows in ranges over (folder, full key): a company with very many branches spans several tasks and files."""
    rows = wide.withColumn("key_part", key_part(F.col(KEY)))
    return rows.repartitionByRange("key_part", KEY).sortWithinPartitions("key_part", KEY)


def write_served(folder: TableFolder, version: str, wide: DataFrame, group_bytes: int = GROUP_BYTES) -> dict[str, str]:
    """Write all parts; returns the version by part, for :meth:`TableFolder.publish`."""
    bloom = {f"parquet.bloom.filter.enabled#{KEY}": "true"}
    rows = folder.write(SERVING, version, by_key(wide), ["key_part"], bloom)
    index = trigram.build_name_index(rows.select(*NAME_COLUMNS), NAME_COLUMNS)
    order = ["field", "trigram", "name"]
    index = index.withColumn("name", F.xxhash64("name"))
    index = folder.write(NAMES, version, index.repartitionByRange(*order).sortWithinPartitions(*order))
    keys = rows.select(F.explode(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)) for c in NAME_COLUMNS])))).alias("name"), KEY)
    folder.write(NAME_ROWS, version, keys.repartitionByRange("name", KEY).sortWithinPartitions("name", KEY))
    # The piece "" of the field "" is every row's.
    counts = index.groupBy("field", "trigram").agg(F.sum("rows").alias("rows")).unionByName(rows.agg(F.lit("").alias("field"), F.lit("").alias("trigram"), F.count("*").alias("rows")))
    folder.write(PIECES, version, counts.repartitionByRange("trigram", "field").sortWithinPartitions("trigram", "field"))
    small = {"parquet.block.size": group_bytes, "parquet.page.size": min(group_bytes, 1 << 20)}
    narrow = folder.write(FILTERS, version, z_ordered(rows.select(*FILTER_COLUMNS), Z_COLUMNS, KEY), options=small)
    folder.write(PLACES, version, narrow.select("municipio", "municipio_descricao").distinct().coalesce(1))
    return dict.fromkeys((SERVING, NAMES, NAME_ROWS, PIECES, FILTERS, PLACES), version)


SERVING_SCHEMA = T.StructType([T.StructField(c, T.TimestampType() if c == "updated_at" else T.StringType()) for c in SERVING_COLUMNS])


class Served:
    """Searches and lookups over one published version.

    Side tables of another version than the rows are not used: a search then scans.
    """

    def __init__(self, folder: TableFolder, versions: Mapping[str, str] | None = None):
        versions = folder.current_versions() if versions is None else versions
        if SERVING not in versions:
            raise S.NotFound("nothing was published to be served")
        version = versions[SERVING]

        def part(name: str, schema) -> DataFrame | None:
            return folder.read(name, version, schema) if versions.get(name) == version else None

        self.placed = folder.read(SERVING, version, T.StructType([*SERVING_SCHEMA.fields, T.StructField("key_part", T.IntegerType())]))
        self.rows = self.placed.select(*SERVING_COLUMNS)
        self.names = part(NAMES, "field string, trigram string, rows bigint, name bigint")
        self.name_rows = part(NAME_ROWS, f"name bigint, {KEY} string")
        self.pieces = part(PIECES, "field string, trigram string, rows bigint")
        self.filters = part(FILTERS, ", ".join(f"{c} string" for c in FILTER_COLUMNS))
        self.places = part(PLACES, "municipio string, municipio_descricao string")

    # ---- by key ----

    def in_folders(self, keys: Sequence[str]) -> DataFrame:
        """Wide rows of the folders that these keys lie in."""
        return self.placed.filter(F.col("key_part").isin(sorted({part_of(k) for k in keys})))

    def lookup(self, key: str, full_length: int = S.FULL_LENGTH) -> DataFrame:
        """The record of a full key, or the first branch of a base key: one folder is read."""
        digits = S.parse_key(key, full_length)
        column = KEY if len(digits) == full_length else "cnpj_basico"
        return self.in_folders([digits]).filter(F.col(column) == digits).select(*SERVING_COLUMNS).orderBy(KEY).limit(1)

    def branches(self, base_key: str, limit: int = S.MAX_BRANCHES) -> DataFrame:
        return S.list_branches(self.in_folders([base_key]).select(*SERVING_COLUMNS), base_key, limit)

    def fetch(self, keys: Sequence[str]) -> DataFrame:
        return self.in_folders(keys).filter(F.col(KEY).isin(list(keys))).select(*SERVING_COLUMNS)

    # ---- by name and filters ----

    def narrow(self, municipio=None, cnae=None, uf=None, situacao=None, simples=None, mei=None) -> DataFrame:
        """Filter columns of the rows that meet all conditions given."""
        found = self.filters
        if municipio:
            codes = [r[0] for r in self.places.filter(contains_ci(F.col("municipio_descricao"), municipio)).select("municipio").distinct().collect()]
            found = found.filter(F.col("municipio").isin(codes) & contains_ci(F.col("municipio_descricao"), municipio))
        condition = S.search_condition(None, None, cnae, uf, situacao)
        if condition is not None:
            found = found.filter(condition)
        for column, value in (("opcao_pelo_simples", simples), ("opcao_pelo_mei", mei)):
            if value:
                found = found.filter(F.col(column) == value.upper())
        return found

    def _named(self, text: str) -> DataFrame | None:
        """Keys of rows that may have the text in a name; None where the side tables do not help."""
        if self.names is None or self.pieces is None or self.name_rows is None:
            return None
        total = self.pieces.filter("trigram = '' AND field = ''").first()["rows"]
        names = trigram.meet(self.names, self.pieces, "name", NAME_COLUMNS, text, total // SELECTIVE)
        if names is None:
            return None
        few = [r[0] for r in names.limit(MOST_KEYS + 1).collect()]
        held = self.name_rows.filter(F.col("name").isin(few)) if len(few) <= MOST_KEYS else self.name_rows.join(names, "name", "left_semi")
        return held.select(KEY).distinct()

    def _first_named(self, keys: DataFrame, condition: Column, limit: int) -> list[str]:
        """The first ``limit`` of ``keys`` whose records meet the condition, a bounded number at a time."""
        found: list[str] = []
        after, size = "", 4 * limit
        for _ in range(ROUNDS):
            batch = [r[0] for r in keys.filter(F.col(KEY) > after).orderBy(KEY).limit(size).collect()]
            if batch:
                found += [r[0] for r in self.fetch(batch).filter(condition).select(KEY).orderBy(KEY).collect()]
            if len(found) >= limit or len(batch) < size:
                return found[:limit]
            after, size = batch[-1], min(4 * size, MOST_KEYS)
        more = self.rows.filter(condition & (F.col(KEY) > after)).join(keys, KEY, "left_semi").select(KEY).orderBy(KEY)
        return found + [r[0] for r in more.limit(limit - len(found)).collect()]

    def search(
        self, *, razao_social: str | None = None, municipio: str | None = None, cnae: str | None = None, uf: str | None = None,
        situacao: str | None = None, simples: str | None = None, mei: str | None = None, limit: int = S.DEFAULT_LIMIT,
    ) -> DataFrame:
        """First matches in key order, 1 to 100 of them: what a scan finds, by way of the side tables.

        A name goes through the posting lists unless its rarest piece is too frequent; without a name the
        narrow columns are filtered. At most ``limit`` wide records are fetched, by key.
        """
        limit = S.clamp_limit(limit)
        condition = S.search_condition(razao_social, municipio, cnae, uf, situacao)
        for column, value in (("opcao_pelo_simples", simples), ("opcao_pelo_mei", mei)):
            if value:
                part = F.col(column) == value.upper()
                condition = part if condition is None else condition & part
        named = self._named(razao_social) if razao_social else None
        if named is not None:
            keys = self._first_named(named, condition, limit)
        elif razao_social or self.filters is None or self.places is None:
            hits = self.rows if condition is None else self.rows.filter(condition)
            keys = [r[0] for r in hits.select(KEY).orderBy(KEY).limit(limit).collect()]
        else:
            hits = self.narrow(municipio, cnae, uf, situacao, simples, mei)
            keys = [r[0] for r in hits.select(KEY).orderBy(KEY).limit(limit).collect()]
        return self.fetch(keys).orderBy(KEY).limit(limit)
