"""Searches and lookups by way of what is published beside the serving rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions.text import zero_pad
from rollbook.operators import partners
from rollbook.plans.served import KEY, Served, write_served
from rollbook.plans.serving import build_serving
from rollbook.sources.registry import SOCIOS
from rollbook.sources.tables import TableFolder
from workload import roles
from workload.catalog import query
from workload.oracle import STAR, sql, zpad
from workload.roles import table
from workload.serving import _once, dated


def published(spark: SparkSession, sf_dir: str) -> Served:
    """All parts, written and published once per data set."""

    def write(path: str) -> None:
        folder = TableFolder(spark, path)
        folder.publish(write_served(folder, "1", build_serving(roles.registry_tables(spark, sf_dir))), "2026-02")

    return Served(TableFolder(spark, _once("served", spark, sf_dir, write)))


def _search(name: str, where: str, rows: int, **arguments) -> None:
    @query(name, sql(STAR, f"SELECT * FROM star {where} ORDER BY cnpj_completo LIMIT {rows}"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dated(published(spark, sf_dir).search(**arguments), "updated_at")


def _named(text: str) -> str:
    return f"(razao_social ILIKE '%{text}%' OR nome_fantasia ILIKE '%{text}%')"


_search("served_name", f"WHERE {_named('mer#00000012')}", 100, razao_social="MER#00000012", limit=100)
_search("served_name_common", f"WHERE {_named('customer')}", 20, razao_social="Customer")
_search("served_name_absent", f"WHERE {_named('xyzzy')}", 20, razao_social="xyzzy")
_search("served_name_and_state", f"WHERE {_named('0000001')} AND uf = 'HI' AND situacao_cadastral = 'O'", 20, razao_social="0000001", uf="hi", situacao="O")
_search("served_cnae", "WHERE cnae_fiscal = '0000011'", 30, cnae="0000011", limit=30)
_search("served_municipality", "WHERE municipio_descricao ILIKE '%nation_1%'", 30, municipio="nation_1", limit=30)
_search("served_status", "WHERE situacao_cadastral = 'P'", 30, situacao="P", limit=30)
_search("served_regime", "WHERE opcao_pelo_simples = 'S' AND opcao_pelo_mei = 'N'", 30, simples="s", mei="n", limit=30)
_search("served_all", "", 20)


@query("served_lookup_full", sql(STAR, "SELECT * FROM star WHERE cnpj_completo = (SELECT max(cnpj_completo) FROM star)"))
def served_lookup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder is read for a full key."""
    served = published(spark, sf_dir)
    key = served.filters.agg(F.max(KEY)).first()[0]
    return dated(served.lookup(key, len(key)), "updated_at")


@query("served_lookup_base", sql(STAR, "SELECT * FROM star WHERE cnpj_basico = (SELECT max(cnpj_basico) FROM star) ORDER BY cnpj_completo LIMIT 1"))
def served_lookup_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """And for a base key."""
    served = published(spark, sf_dir)
    return dated(served.lookup(served.filters.agg(F.max(F.substring(KEY, 1, 8))).first()[0]), "updated_at")


@query("served_branches", sql(STAR, "SELECT * FROM star WHERE cnpj_basico = (SELECT max(cnpj_basico) FROM star) ORDER BY cnpj_ordem, cnpj_dv LIMIT 100"))
def served_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = published(spark, sf_dir)
    return dated(served.branches(served.filters.agg(F.max(F.substring(KEY, 1, 8))).first()[0]), "updated_at")


@query(
    "piece_counts",
    sql(
        STAR, "SELECT field, trigram, count(*) AS rows FROM (SELECT DISTINCT cnpj_completo, field, substr(lower(name), i, 3) AS trigram FROM "
        "(SELECT cnpj_completo, field, name, unnest(range(1, length(name) - 1)) AS i FROM (SELECT cnpj_completo, 'razao_social' AS field, razao_social AS name FROM star "
        "UNION ALL SELECT cnpj_completo, 'nome_fantasia', nome_fantasia FROM star))) GROUP BY ALL",
    ),
)
def piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long each posting list is."""
    return published(spark, sf_dir).pieces.filter("trigram <> ''")


def _partner_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Partners and regimes, saved once per data set: suppliers and customers are partners, of the company of their number."""
    tables = {}

    def write(path: str) -> None:
        customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
        people = roles.filled(
            customer, SOCIOS, cnpj_basico=zero_pad(F.col("c_custkey"), 8), nome_socio=F.col("c_name"), qualificacao_socio=zero_pad(F.col("c_nationkey"), 2)
        ).unionByName(roles.filled(supplier, SOCIOS, cnpj_basico=zero_pad(F.col("s_suppkey"), 8), nome_socio=F.col("s_name"), qualificacao_socio=zero_pad(F.col("s_nationkey"), 2)))
        for name, df in (("socios", people), ("simples", roles.simples(customer))):
            partners.save_by_company(df, f"rollbook_{name}_{path.rsplit('-', 1)[1]}", f"{path}/{name}")

    path = _once("partners", spark, sf_dir, write)
    for name in ("socios", "simples"):
        tables[name] = spark.table(f"rollbook_{name}_{path.rsplit('-', 1)[1]}")
    return tables["socios"], tables["simples"]


_PARTNERS = (
    f"SELECT p.cnpj_basico, p.nome_socio, p.qualificacao_socio, s.opcao_pelo_simples, s.opcao_pelo_mei FROM (SELECT {zpad('c_custkey', 8)} AS cnpj_basico, c_name AS nome_socio, "
    f"{zpad('c_nationkey', 2)} AS qualificacao_socio FROM customer UNION ALL SELECT {zpad('s_suppkey', 8)}, s_name, {zpad('s_nationkey', 2)} FROM supplier) p LEFT JOIN simples s ON s.cnpj_basico = p.cnpj_basico"
)
_PARTNER_COLUMNS = ("cnpj_basico", "nome_socio", "qualificacao_socio", "opcao_pelo_simples", "opcao_pelo_mei")


@query("partners_of", sql("simples", _PARTNERS + " WHERE p.cnpj_basico IN ('00000003', '00000007', '00000099')"))
def partners_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three companies: their buckets are read, and nothing is shuffled."""
    return partners.partners_of(*_partner_tables(spark, sf_dir), ["00000007", "00000003", "00000099"]).select(*_PARTNER_COLUMNS)


@query("partners_with_regime", sql("simples", _PARTNERS))
def partners_with_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all companies: bucket by bucket."""
    return partners.with_regime(*_partner_tables(spark, sf_dir)).select(*_PARTNER_COLUMNS)
