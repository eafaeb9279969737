"""Search and lookup over the serving table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollbook.functions.text import contains_ci, digits_only
from rollbook.operators.joins import join_unique

# Page size of a search, number of branches listed, key lengths.
DEFAULT_LIMIT, MAX_LIMIT, MAX_BRANCHES = 20, 100, 100
BASE_LENGTH, FULL_LENGTH = 8, 14


class InvalidKey(ValueError):
    pass


class NotFound(LookupError):
    pass


def clamp_limit(limit: int, highest: int = MAX_LIMIT) -> int:
    return max(1, min(limit, highest))


def search_condition(
    razao_social: str | None = None, municipio: str | None = None, cnae: str | None = None,
    uf: str | None = None, situacao: str | None = None,
) -> Column | None:
    """All given conditions together; None or empty text sets no condition."""
    parts: list[Column] = []
    if razao_social:
        parts.append(
            contains_ci(F.col("razao_social"), razao_social) | contains_ci(F.col("nome_fantasia"), razao_social)
        )
    if municipio:
        parts.append(contains_ci(F.col("municipio_descricao"), municipio))
    if cnae:
        parts.append(F.col("cnae_fiscal") == cnae)
    if uf:
        parts.append(F.col("uf") == uf.upper())
    if situacao:
        parts.append(F.col("situacao_cadastral") == situacao)
    condition = None
    for part in parts:
        condition = part if condition is None else condition & part
    return condition


def fetch(serving: DataFrame, found: list, key: str = "cnpj_completo", folder: str = "uf") -> DataFrame:
    """Whole records of a short list of rows that hold at least the key.

    The keys, and the folders they lie in, become conditions the scan can skip files and row groups by.
    """
    hits = serving.filter(F.col(key).isin([r[key] for r in found]))
    folders = {r[folder] for r in found} if found and folder in found[0] else set()
    return hits.filter(F.col(folder).isin(list(folders))) if folders and None not in folders else hits


def search(
    serving: DataFrame, *, razao_social: str | None = None, municipio: str | None = None,
    cnae: str | None = None, uf: str | None = None, situacao: str | None = None, limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """First matches in key order, 1 to 100 of them.

    Two steps: the whole table is searched in the few columns the conditions need; the wide records
    are then fetched for the at most 100 keys found.
    """
    condition = search_condition(razao_social, municipio, cnae, uf, situacao)
    hits = serving if condition is None else serving.filter(condition)
    found = hits.select("cnpj_completo", "uf").orderBy("cnpj_completo").limit(clamp_limit(limit)).collect()
    return fetch(serving, found).orderBy("cnpj_completo").limit(clamp_limit(limit))


def parse_key(key: str, full_length: int = FULL_LENGTH) -> str:
    """Digits of a key as typed; 8 (base) or 14 (full) of them are needed.

    ``full_length`` is for tables whose branch numbers have outgrown their four digits.
    """
    digits = re.sub(r"\D", "", key, flags=re.ASCII)
    if len(digits) not in (BASE_LENGTH, full_length):
        raise InvalidKey(f"a key has {BASE_LENGTH} (base) or {full_length} digits, not {len(digits)}")
    return digits


def lookup(serving: DataFrame, key: str, full_length: int = FULL_LENGTH) -> DataFrame:
    """The record of a full key, or the first branch of a base key. Both columns are pushed to the scan."""
    digits = parse_key(key, full_length)
    hit = (F.col("cnpj_completo") == digits) | (F.col("cnpj_basico") == digits)
    return serving.filter(hit).orderBy("cnpj_completo").limit(1)


def lookup_one(serving: DataFrame, key: str):
    row = lookup(serving, key).first()
    if row is None:
        raise NotFound(f"no record for {parse_key(key)}")
    return row


def list_branches(serving: DataFrame, base_key: str, limit: int = MAX_BRANCHES) -> DataFrame:
    """Branches of a company by number."""
    return serving.filter(F.col("cnpj_basico") == base_key).orderBy("cnpj_ordem", "cnpj_dv").limit(limit)


def bulk_lookup(serving: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Look up a whole column of keys as typed: ``status`` is found, not_found or invalid.

    The asked keys are made distinct first. Base keys become full keys in two narrow columns of the table: the
    least full key per asked company, combined before the shuffle. Wide records are then joined once, by full
    key, and the answers go back to the asked rows, where a key that very many ask for may be split.
    """
    digits = digits_only(F.col(key))
    asked = keys.select(F.col(key), digits.alias("__k"))
    wanted = asked.select("__k").filter(F.length("__k").isin(BASE_LENGTH, FULL_LENGTH)).distinct()
    bases = wanted.filter(F.length("__k") == BASE_LENGTH)
    firsts = (
        serving.select(F.col("cnpj_basico").alias("__k"), F.col("cnpj_completo").alias("__full"))
        .join(bases, "__k", "left_semi").groupBy("__k").agg(F.min("__full").alias("__full"))
    )
    fulls = wanted.filter(F.length("__k") == FULL_LENGTH).select("__k", F.col("__k").alias("__full"))
    records = serving.select(F.col("cnpj_completo").alias("__full"), F.struct(*serving.columns).alias("record"))
    answers = firsts.unionByName(fulls).join(records, "__full").select("__k", "record")
    valid = F.coalesce(F.length("__k").isin(BASE_LENGTH, FULL_LENGTH), F.lit(False))
    status = F.when(~valid, "invalid").when(F.col("record").isNotNull(), "found").otherwise("not_found")
    return join_unique(asked, answers, "__k", "left").select(key, status.alias("status"), "record.*")


# Field order of an answer record.
RESPONSE_COLUMNS = (
    "cnpj_completo", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "razao_social", "nome_fantasia",
    "natureza_juridica", "natureza_juridica_descricao", "porte", "porte_descricao", "capital_social",
    "situacao_cadastral", "motivo_situacao_descricao", "data_inicio_atividade", "cnae_fiscal",
    "cnae_fiscal_descricao", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "uf", "municipio", "municipio_descricao", "ddd1", "telefone1",
    "correio_eletronico", "identificador_matriz_filial", "situacao_especial", "data_situacao_especial",
    "nm_cidade_exterior", "pais", "ddd2", "telefone2", "ddd_fax", "fax", "qualificacao_responsavel",
    "ente_federativo_responsavel", "data_situacao_cadastral", "opcao_pelo_simples", "data_opcao_simples",
    "data_exclusao_simples", "opcao_pelo_mei", "data_opcao_mei", "data_exclusao_mei", "updated_at", "run_key",
)
RESPONSE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RESPONSE_COLUMNS])


def response(df: DataFrame) -> DataFrame:
    """Answer records: fixed fields, all text, null where the table has no such column."""

    def field(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("string")
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            # Microseconds only where there are any; a time with a zone is given in UTC.
            zoned = isinstance(df.schema[name].dataType, T.TimestampType)
            at = F.to_utc_timestamp(name, F.current_timezone()) if zoned else F.col(name)
            whole, parts = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(at, "SSSSSS")
            return F.concat(whole, F.when(parts == "000000", "").otherwise(F.concat(F.lit("."), parts)), F.lit("+00:00" if zoned else ""))
        return F.col(name).cast("string")

    return df.select(*[field(c).alias(c) for c in RESPONSE_COLUMNS])
