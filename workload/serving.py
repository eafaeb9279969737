"""Serving view, search and lookup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.operators import search as S, trigram
from rollbook.operators.joins import SALTS, join_unique
from rollbook.plans.serving import build_serving, laid_out
from rollbook.session import work_dir
from rollbook.sources.tables import TableFolder
from workload import roles
from workload.catalog import query
from workload.oracle import SKEWED_BRANCHES, STAR, sql, zpad
from workload.roles import STAMP_FORMAT, table


def dated(df: DataFrame, *columns: str) -> DataFrame:
    """Time stamps as text, so that both engines print them alike."""
    return df.withColumns({c: F.date_format(c, STAMP_FORMAT) for c in columns})


# What was written once for a data set in this application: serving tables and piece tables.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, write: Callable[[str], None]) -> str:
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = work_dir(spark, kind)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table as readers see it: written once per data set, read by every search."""

    def write(path: str) -> None:
        view = laid_out(build_serving(roles.registry_tables(spark, sf_dir)))
        TableFolder(spark, path).write("serving", "1", view, ["uf"])

    path = _once("serving", spark, sf_dir, write)
    return dated(spark.read.parquet(TableFolder(spark, path).path("serving", "1")), "updated_at")


@query("star_view", sql(STAR, "SELECT * FROM star"))
def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(build_serving(roles.registry_tables(spark, sf_dir)), "updated_at")


_KNOWN = "SELECT n.* FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey WHERE r.r_name <> 'ASIA'"


@query("star_view_missing_lookup", sql(STAR, "SELECT * FROM star", known_nations=_KNOWN))
def star_view_missing_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes without a description stay, with a null description."""
    known = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").filter("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey")),
        "n_regionkey",
    )
    tables = roles.registry_tables(spark, sf_dir)
    tables.update(
        cnaes=roles.nation_codes(known, 7), municipios=roles.nation_codes(known, 4),
        naturezas=roles.nation_codes(known, 4),
    )
    return dated(build_serving(tables), "updated_at")


@query(
    "orphan_drop",
    sql(
        STAR, "SELECT cnpj_completo, razao_social FROM star WHERE cnpj_basico IN "
        f"(SELECT {zpad('c_custkey', 8)} FROM customer WHERE c_acctbal >= 0)",
    ),
)
def orphan_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches whose company is gone do not reach the view."""
    tables = roles.registry_tables(spark, sf_dir)
    solvent = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    tables["empresas"] = roles.stamped(roles.empresas(solvent))
    return build_serving(tables).select("cnpj_completo", "razao_social")


@query("star_view_hot_keys", sql(STAR, "SELECT * FROM star", estabelecimentos=SKEWED_BRANCHES))
def star_view_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view where a third of all branches belong to one company."""
    tables = roles.registry_tables(spark, sf_dir)
    tables["estabelecimentos"] = roles.skewed_branches(table(spark, sf_dir, "orders"))
    return dated(build_serving(tables), "updated_at")


_HOT_PART = "CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 1 ELSE l_partkey END"


@query(
    "hot_key_join",
    f"SELECT o_orderkey, l_linenumber, {_HOT_PART} AS l_partkey, p_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
    f"JOIN part ON p_partkey = {_HOT_PART}",
)
def hot_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fact-to-dimension joins where a third of all lines are of one part; the first one is salted."""
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.expr(_HOT_PART).alias("p_partkey"), "l_linenumber"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = join_unique(join_unique(line, part, "p_partkey", salts=SALTS), orders, "o_orderkey", merge=True)
    return joined.select("o_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"), "p_name")


@query("response_records", sql(STAR, "SELECT * REPLACE (replace(updated_at, ' ', 'T') || '.123456+00:00' AS updated_at) FROM star"))
def response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer records; their stamps have microseconds."""
    view = build_serving(roles.registry_tables(spark, sf_dir))
    return S.response(view.withColumn("updated_at", F.col("updated_at") + F.expr("interval 123456 microseconds")))


def _search(name: str, where: str, rows: int, **arguments) -> None:
    @query(name, sql(STAR, f"SELECT * FROM star {where} ORDER BY cnpj_completo LIMIT {rows}"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.search(served(spark, sf_dir), **arguments)


_search("search_name", "WHERE razao_social ILIKE '%mer#00000001%' OR nome_fantasia ILIKE '%mer#00000001%'", 100,
        razao_social="MER#00000001", limit=100)
_search("search_trade_name", "WHERE razao_social ILIKE '%t spec_fied p%' OR nome_fantasia ILIKE '%t spec_fied p%'", 20,
        razao_social="t spec_fied p")
_search("search_municipality", "WHERE municipio_descricao ILIKE '%nation_1%'", 50, municipio="nation_1", limit=50)
_search(
    "search_filters",
    "WHERE municipio_descricao ILIKE '%NATION%' AND cnae_fiscal = '0000007' AND uf = 'HI' AND situacao_cadastral = 'F'",
    100, municipio="NATION", cnae="0000007", uf="hi", situacao="F", limit=500,
)
_search("search_all_limit", "", 20, razao_social="", uf=None)
_search("search_lowest_limit", "WHERE uf = 'UR'", 1, uf="ur", limit=-3)


_NAMES = ["razao_social", "nome_fantasia"]


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        trigram.write_index(trigram.build_name_index(served(spark, sf_dir).select(*_NAMES), _NAMES), path)

    return spark.read.parquet(_once("trigrams", spark, sf_dir, write))


@query(
    "search_trigram",
    sql(STAR, "SELECT * FROM star WHERE razao_social ILIKE '%r#0000000%' OR nome_fantasia ILIKE '%r#0000000%'"),
)
def search_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hits of a substring search by way of the side table."""
    return trigram.search_names(served(spark, sf_dir), _pieces(spark, sf_dir), _NAMES, "R#0000000")


@query(
    "search_trigram_selective",
    sql(STAR, "SELECT * FROM star WHERE razao_social ILIKE '%00000123%' OR nome_fantasia ILIKE '%00000123%'"),
)
def search_trigram_selective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few hits."""
    return trigram.search_names(served(spark, sf_dir), _pieces(spark, sf_dir), _NAMES, "00000123")


@query("search_trigram_part", "SELECT * FROM part WHERE p_name ILIKE '%d Pl%' OR p_type ILIKE '%d Pl%'")
def search_trigram_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    index = trigram.build_index(part, "p_partkey", ["p_name", "p_type"])
    return trigram.search_indexed(part, index, "p_partkey", ["p_name", "p_type"], "d Pl")


@query(
    "trigram_index",
    "WITH pieces AS (SELECT DISTINCT doc_id, substr(lower(text), i, 3) AS trigram FROM "
    "(SELECT doc_id, text, unnest(range(1, length(text) - 1)) AS i FROM documents)) "
    "SELECT trigram, count(*) AS rows FROM pieces GROUP BY trigram",
)
def trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings per piece over whole document texts."""
    index = trigram.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return index.groupBy("trigram").agg(F.count("*").alias("rows"))


@query(
    "lookup_full",
    sql(STAR, "SELECT * FROM star WHERE cnpj_completo = (SELECT max(cnpj_completo) FROM star)"),
)
def lookup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of a full key as typed, here the highest one."""
    view = served(spark, sf_dir)
    key = view.agg(F.max("cnpj_completo")).first()[0]
    return S.lookup(view, f"{key[:2]}.{key[2:5]}.{key[5:8]}/{key[8:-2]}-{key[-2:]}", len(key))


@query(
    "lookup_base",
    sql(STAR, "SELECT * FROM star WHERE cnpj_basico = (SELECT max(cnpj_basico) FROM star) ORDER BY cnpj_completo LIMIT 1"),
)
def lookup_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = served(spark, sf_dir)
    return S.lookup(view, view.agg(F.max("cnpj_basico")).first()[0])


@query(
    "list_branches",
    sql(
        STAR, "SELECT * FROM star WHERE cnpj_basico = (SELECT max(cnpj_basico) FROM star) "
        "ORDER BY cnpj_ordem, cnpj_dv LIMIT 100",
    ),
)
def list_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = served(spark, sf_dir)
    return S.list_branches(view, view.agg(F.max("cnpj_basico")).first()[0])


_ASKED = (
    "asked AS (SELECT substr(k, 1, 2) || '.' || substr(k, 3) AS key, k AS digits FROM (SELECT cnpj_basico AS k FROM "
    "empresas) UNION ALL SELECT cnpj_basico || '/' || cnpj_ordem || '-' || cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv "
    "FROM estabelecimentos UNION ALL SELECT s_name, substr(s_name, 10) FROM supplier UNION ALL "
    "SELECT 'X' || lpad(CAST(90000000 + p_partkey AS VARCHAR), 8, '0'), CAST(90000000 + p_partkey AS VARCHAR) FROM part)"
)


@query(
    "bulk_lookup",
    sql(STAR, "")
    + f", {_ASKED}, firsts AS (SELECT cnpj_basico AS b, min(cnpj_completo) AS c FROM star GROUP BY 1), "
    "hit AS (SELECT key, digits, CASE WHEN length(digits) = 8 THEN f.c WHEN length(digits) = 14 THEN digits END AS c "
    "FROM asked LEFT JOIN firsts f ON f.b = digits) "
    "SELECT key, CASE WHEN length(digits) NOT IN (8, 14) THEN 'invalid' WHEN s.cnpj_completo IS NULL THEN 'not_found' "
    "ELSE 'found' END AS status, s.cnpj_completo, s.razao_social, s.municipio_descricao "
    "FROM hit LEFT JOIN star s ON s.cnpj_completo = hit.c AND length(digits) IN (8, 14)",
)
def bulk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company, every branch, and two tables of keys that do not fit or do not exist."""
    view = served(spark, sf_dir)
    base = roles.empresas(table(spark, sf_dir, "customer")).select(
        F.concat(F.substring("cnpj_basico", 1, 2), F.lit("."), F.substring("cnpj_basico", 3, 100)).alias("key")
    )
    full = roles.estabelecimentos(table(spark, sf_dir, "orders")).select(
        F.concat("cnpj_basico", F.lit("/"), "cnpj_ordem", F.lit("-"), "cnpj_dv").alias("key")
    )
    wrong = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("key"))
    unknown = table(spark, sf_dir, "part").select(
        F.concat(F.lit("X"), (F.col("p_partkey") + 90000000).cast("string")).alias("key")
    )
    keys = base.unionByName(full).unionByName(wrong).unionByName(unknown)
    found = S.bulk_lookup(view.select("cnpj_completo", "cnpj_basico", "razao_social", "municipio_descricao"), keys)
    return found.select("key", "status", "cnpj_completo", "razao_social", "municipio_descricao")


@query(
    "serving_layout",
    sql(STAR, "SELECT uf, situacao_cadastral, count(*) AS rows, min(cnpj_completo) AS first_key FROM star "
              "WHERE uf IN ('HI', 'UR') GROUP BY ALL"),
)
def serving_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that reads only the folders of two states."""
    return (
        served(spark, sf_dir).filter(F.col("uf").isin("HI", "UR"))
        .groupBy("uf", "situacao_cadastral")
        .agg(F.count("*").alias("rows"), F.min("cnpj_completo").alias("first_key"))
    )
