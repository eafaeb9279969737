"""The provided tables in the roles of the registry tables.

Branches are orders, companies and tax regimes are customers, code tables come from nations, market
segments and order priorities, run events are events, and drop listings are documents. The derivations
read whole tables; the SQL in ``oracle.py`` spells out the same ones.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.functions.text import zero_pad
from rollbook.sources.registry import EMPRESAS, ESTABELECIMENTOS, LAYOUTS, SIMPLES

OLD_KEY, NEW_KEY = "2026-02", "2026-03"
OLD_STAMP, NEW_STAMP = "2026-02-01 00:00:00", "2026-03-01 00:00:00"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
NBSP = "\u00a0"
#: Orders as branches have numbers of as many digits as their keys need, not of the four that the published files declare.
BRANCHES = replace(ESTABELECIMENTOS, lengths={**ESTABELECIMENTOS.lengths, "cnpj_ordem": 17})
ROLE_LAYOUTS = {**LAYOUTS, BRANCHES.name: BRANCHES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamped(df: DataFrame, run_key: str = OLD_KEY, stamp: str = OLD_STAMP) -> DataFrame:
    now = F.lit(stamp).cast("timestamp")
    return df.select("*", F.lit(run_key).alias("run_key"), now.alias("created_at"), now.alias("updated_at"))


def filled(df: DataFrame, layout, **fields: Column) -> DataFrame:
    """Layout columns in order; those not given are null."""
    null = F.lit(None).cast("string")
    return df.select(*[fields.get(c, null).alias(c) for c in layout.columns])


def money_text(c: str) -> Column:
    return F.replace(F.col(c).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def empresas(customer: DataFrame) -> DataFrame:
    return filled(
        customer, EMPRESAS,
        cnpj_basico=zero_pad(F.col("c_custkey"), 8),
        razao_social=F.col("c_name"),
        natureza_juridica=zero_pad(F.col("c_nationkey"), 4),
        qualificacao_responsavel=zero_pad(F.col("c_nationkey"), 2),
        capital_social=money_text("c_acctbal"),
        porte=F.substring("c_mktsegment", 1, 2),
        ente_federativo_responsavel=F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")),
    )


def simples(customer: DataFrame) -> DataFrame:
    member = F.when(F.col("c_acctbal") >= 5000, "S").otherwise("N")
    return filled(
        customer.filter(F.col("c_mktsegment") != "MACHINERY"), SIMPLES,
        cnpj_basico=zero_pad(F.col("c_custkey"), 8),
        opcao_pelo_simples=member,
        data_opcao_simples=F.when(F.col("c_acctbal") >= 5000, "20150101"),
        opcao_pelo_mei=F.when(F.col("c_nationkey") < 5, "S").otherwise("N"),
    )


def estabelecimentos(orders: DataFrame) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return filled(
        orders, ESTABELECIMENTOS,
        cnpj_basico=zero_pad(F.col("o_custkey"), 8),
        cnpj_ordem=zero_pad(F.expr("o_orderkey div 100"), 4),
        cnpj_dv=zero_pad(F.expr("o_orderkey % 100"), 2),
        identificador_matriz_filial=F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("2"),
        nome_fantasia=F.concat_ws(" ", "o_orderpriority", "o_orderstatus"),
        situacao_cadastral=F.col("o_orderstatus"),
        data_situacao_cadastral=day,
        motivo_situacao_cadastral=F.substring("o_orderpriority", 1, 1),
        data_inicio_atividade=day,
        cnae_fiscal=zero_pad(F.floor(F.col("o_totalprice") / 20000), 7),
        tipo_logradouro=F.lit("RUA"),
        numero=F.col("o_custkey").cast("string"),
        uf=F.upper(F.substring("o_orderpriority", 3, 2)),
        municipio=zero_pad(F.dayofmonth("o_orderdate"), 4),
        correio_eletronico=F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")),
    )


def skewed_branches(orders: DataFrame) -> DataFrame:
    """Branches of which a third belong to one company."""
    company = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    return stamped(estabelecimentos(orders.withColumn("o_custkey", company)))


def nation_codes(nation: DataFrame, width: int) -> DataFrame:
    return nation.select(zero_pad(F.col("n_nationkey"), width).alias("codigo"), F.col("n_name").alias("descricao"))


def registry_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables the serving view reads, with the stamps of the old run."""
    customer, orders, nation = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    return {
        "empresas": stamped(empresas(customer)),
        "estabelecimentos": stamped(estabelecimentos(orders)),
        "simples": stamped(simples(customer)).drop("created_at"),
        "cnaes": nation_codes(nation, 7),
        "municipios": nation_codes(nation, 4),
        "naturezas": nation_codes(nation, 4),
        "motivos": orders.groupBy(F.substring("o_orderpriority", 1, 1).alias("codigo")).agg(
            F.min(F.substring("o_orderpriority", 3, 100)).alias("descricao")
        ),
        "portes": customer.groupBy(F.substring("c_mktsegment", 1, 2).alias("codigo")).agg(
            F.min("c_mktsegment").alias("descricao")
        ),
    }


def branch_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current branches and the next full dump of them.

    The current table ends in 2000; the dump has the orders of 2001, too, but no longer the closed
    ones from before 1997. In between, pending orders got another status, and medium ones lost their
    reason code. Parts without a branch number come along as rows without a complete key.
    """
    orders = table(spark, sf_dir, "orders")
    main = stamped(estabelecimentos(orders.filter("o_orderdate < timestamp_ntz'2001-01-01'")))
    kept = orders.filter("not (o_orderstatus = 'F' and o_orderdate < timestamp_ntz'1997-01-01')")
    staging = estabelecimentos(kept).withColumns(
        {
            "situacao_cadastral": F.when(F.col("situacao_cadastral") == "P", "O").otherwise(
                F.col("situacao_cadastral")
            ),
            "motivo_situacao_cadastral": F.when(
                F.col("motivo_situacao_cadastral") != "3", F.col("motivo_situacao_cadastral")
            ),
        }
    )
    blank = filled(
        table(spark, sf_dir, "part"), ESTABELECIMENTOS,
        cnpj_basico=zero_pad(F.col("p_partkey"), 8),
        cnpj_ordem=F.when(F.col("p_size") > 25, "   "),
        cnpj_dv=F.lit("00"),
        nome_fantasia=F.col("p_name"),
    )
    return main, staging.unionByName(blank)


def raw_companies(customer: DataFrame) -> DataFrame:
    """Company rows as they might come in: padded cells, "no value" markers, lost keys, empty rows."""
    lost = F.col("c_acctbal") < 0
    wiped = lost & (F.col("c_mktsegment") == "FURNITURE")

    def cell(c: Column) -> Column:
        return F.when(wiped, F.lit(" \t")).otherwise(c)

    key = F.concat(F.lit(NBSP), zero_pad(F.col("c_custkey"), 8), F.lit("\t "))
    return customer.select(
        cell(
            F.when(lost & (F.col("c_mktsegment") == "BUILDING"), "")
            .when(lost & (F.col("c_mktsegment") == "MACHINERY"), "00000000")
            .otherwise(key)
        ).alias("cnpj_basico"),
        cell(F.concat(F.lit("  "), F.col("c_name"), F.lit(NBSP))).alias("razao_social"),
        cell(F.when(F.col("c_nationkey") == 7, "000").otherwise(zero_pad(F.col("c_nationkey"), 4))).alias(
            "natureza_juridica"
        ),
        cell(F.when(F.col("c_nationkey") == 8, "na").otherwise(zero_pad(F.col("c_nationkey"), 2))).alias(
            "qualificacao_responsavel"
        ),
        cell(money_text("c_acctbal")).alias("capital_social"),
        cell(F.when(F.col("c_mktsegment") == "HOUSEHOLD", " NA ").otherwise(F.substring("c_mktsegment", 1, 2))).alias(
            "porte"
        ),
        cell(
            F.when(F.col("c_acctbal") > 9000, "N/A").when(F.col("c_acctbal") > 8000, "0001-01-01").otherwise("")
        ).alias("ente_federativo_responsavel"),
    )


def files(documents: DataFrame) -> DataFrame:
    """A drop listing: documents as files, named by language and source."""
    stem = (
        F.when(F.col("lang") == "en", "Empresas")
        .when(F.col("lang") == "fr", "Socios")
        .when(F.col("lang") == "de", "old_CNAES")
        .otherwise("Notes")
    )
    ending = F.when(F.col("source").endswith("3"), ".txt").when(F.col("source").endswith("5"), ".ZIP").otherwise(".zip")
    name = F.concat(stem, F.col("doc_id").cast("string"), ending)
    return documents.select(
        name.alias("name"),
        F.concat(F.col("source"), F.lit("/"), name).alias("path"),
        (F.col("source") == "src7").alias("is_dir"),
        F.col("n_chars").alias("size"),
        F.lit("").alias("modified"),
        F.md5("text").alias("etag"),
        "source",
        "lang",
    )


def listings(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two listings of the same share: one source left, one came, Spanish files changed."""
    all_files = files(documents)
    old = all_files.filter(F.col("source") != "src1")
    new = all_files.filter(F.col("source") != "src2").withColumn(
        "etag", F.when(F.col("lang") == "es", F.concat("etag", F.lit("-2"))).otherwise(F.col("etag"))
    )
    return old, new


def run_events(events: DataFrame) -> DataFrame:
    """Events as status changes of jobs (users) and steps (the ``k`` of the properties)."""
    status = (
        F.when(F.col("event_type") == "click", "RUNNING")
        .when(F.col("event_type") == "purchase", "SUCCESS")
        .when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "view", "SKIPPED")
        .otherwise("PENDING")
    )
    return events.select(
        F.col("user_id").cast("string").alias("job_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_key"),
        F.concat(F.lit("step_"), F.get_json_object("props", "$.k")).alias("step_name"),
        status.alias("status"),
        "ts",
        F.when(status == "FAILED", F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("error"),
        F.when(status == "SUCCESS", F.concat(F.lit("out/"), F.col("event_id").cast("string"))).alias("artifact_path"),
        F.col("event_id").alias("seq"),
    )
