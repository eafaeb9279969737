"""The wide serving table: every branch with its company, tax regime and decoded codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from rollbook.functions.keys import composite_key
from rollbook.operators.checks import CheckFailed
from rollbook.operators.joins import decode, join_unique

# Column order of the serving table.
SERVING_COLUMNS = (
    "cnpj_completo", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "razao_social", "natureza_juridica",
    "natureza_juridica_descricao", "porte", "porte_descricao", "capital_social", "qualificacao_responsavel",
    "ente_federativo_responsavel", "nome_fantasia", "identificador_matriz_filial", "situacao_cadastral",
    "motivo_situacao_descricao", "data_situacao_cadastral", "data_inicio_atividade", "cnae_fiscal",
    "cnae_fiscal_descricao", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "uf", "municipio", "municipio_descricao", "nm_cidade_exterior", "pais",
    "ddd1", "telefone1", "ddd2", "telefone2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial",
    "data_situacao_especial", "opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_pelo_mei", "data_opcao_mei", "data_exclusao_mei", "run_key", "updated_at",
)
# Code table, code column and resulting description, per side of the join.
COMPANY_CODES = (
    ("naturezas", "natureza_juridica", "natureza_juridica_descricao"),
    ("portes", "porte", "porte_descricao"),
)
BRANCH_CODES = (
    ("cnaes", "cnae_fiscal", "cnae_fiscal_descricao"),
    ("municipios", "municipio", "municipio_descricao"),
    ("motivos", "motivo_situacao_cadastral", "motivo_situacao_descricao"),
)
TAX_REGIME_COLUMNS = (
    "opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_pelo_mei", "data_opcao_mei",
    "data_exclusao_mei",
)


def _decoded(df: DataFrame, tables: Mapping[str, DataFrame | None], codes) -> DataFrame:
    for name, code, into in codes:
        table = tables.get(name)
        if table is None:
            df = df.withColumn(into, F.lit(None).cast("string"))
        else:
            df = decode(df, code, table, into)
    return df


def build_serving(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Serving rows from the current tables (``tables`` by name; a code table may be missing).

    Company-level work is done once per company: company and tax regime are unique on the same key, so
    their join is not skewed.
    Only branches can pile up on one company. Adaptive execution splits such a company where both sides of the
    join come straight from a shuffle that the join asked for, and nothing after it needs its partitioning. So
    the company key is made a new value, which hides how company rows lie already. Companies are hashed and branches stream past them: a task's
    memory does not grow with the branches of one company. Branches without a company are dropped. ``run_key`` and ``updated_at`` are the
    company's. Without companies or branches there is nothing to serve: ``CheckFailed``.
    """
    for name in ("empresas", "estabelecimentos"):
        if tables.get(name) is None:
            raise CheckFailed(f"{name} was never loaded, nothing can be served")
    company = tables["empresas"].drop("created_at")
    regime = tables.get("simples")
    if regime is None:
        for c in TAX_REGIME_COLUMNS:
            company = company.withColumn(c, F.lit(None).cast("string"))
    else:
        company = company.join(regime.select("cnpj_basico", *TAX_REGIME_COLUMNS), "cnpj_basico", "left")
    company = _decoded(company, tables, COMPANY_CODES)
    company = company.withColumn("cnpj_basico", F.concat("cnpj_basico", F.lit("")))

    branch = tables["estabelecimentos"].drop("run_key", "created_at", "updated_at")
    branch = _decoded(branch, tables, BRANCH_CODES)

    wide = join_unique(branch, company, "cnpj_basico", hashed=True)
    wide = wide.withColumn("cnpj_completo", composite_key("cnpj_basico", "cnpj_ordem", "cnpj_dv"))
    return wide.select(*SERVING_COLUMNS)


def laid_out(serving: DataFrame) -> DataFrame:
    """Rows arranged for writing by state: ranges over (state, full key), sorted within.

    The full key is unique, so neither a large state nor a company with very many branches ends up in
    one task, and each file covers a narrow key range that point lookups can skip by its statistics. The full key does not
    cross the shuffle: it is put together from its parts on either side.
    """
    key = composite_key("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    dealt = serving.drop("cnpj_completo").repartitionByRange("uf", key).withColumn("cnpj_completo", key)
    return dealt.sortWithinPartitions("uf", "cnpj_completo").select(serving.columns)
