"""Merge, replace, and the checks before them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions.text import zero_pad
from rollbook.operators import checks, merge as M
from rollbook.operators.cleaning import overlength
from rollbook.session import work_dir
from rollbook.sources.registry import ESTABELECIMENTOS, SOCIOS
from rollbook.sources.tables import save_bucketed
from workload import roles
from workload.catalog import query
from workload.oracle import CHANGED, MERGE, MERGED, PRESENT, SAME_KEY, sql, zpad
from workload.roles import NEW_KEY, NEW_STAMP, table
from workload.serving import dated

KEY, DATA = ESTABELECIMENTOS.key, ESTABELECIMENTOS.data_columns


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, staging = roles.branch_snapshots(spark, sf_dir)
    return M.three_way_merge(main, staging, KEY, DATA, NEW_KEY, NEW_STAMP)


@query("merge_changes", sql(MERGED, "SELECT * FROM merged"))
def merge_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(_merged(spark, sf_dir), "created_at", "updated_at")


@query("merge_bucketed", sql(MERGED, "SELECT * FROM merged"))
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge with the current table bucketed by its key: only the dump is shuffled."""
    main, staging = roles.branch_snapshots(spark, sf_dir)
    path = work_dir(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = save_bucketed(main, "rollbook_" + path.rsplit("-", 1)[1], path, KEY, buckets)
    return dated(M.three_way_merge(current, staging, KEY, DATA, NEW_KEY, NEW_STAMP), "created_at", "updated_at")


@query("merge_snapshot", sql(MERGED, "SELECT * EXCLUDE (op) FROM merged WHERE op <> 'delete'"))
def merge_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(M.snapshot(_merged(spark, sf_dir)), "created_at", "updated_at")


@query(
    "merge_counts",
    sql(
        MERGED, "SELECT count(*) FILTER (op = 'insert') AS inserted, count(*) FILTER (op = 'update') AS updated, "
        "count(*) FILTER (op = 'delete') AS deleted FROM merged",
    ),
)
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_counts(_merged(spark, sf_dir))


@query(
    "merge_inserts",
    sql(MERGE, f"SELECT s.* FROM staging_rows s WHERE {PRESENT} AND NOT EXISTS (SELECT 1 FROM main_rows t WHERE {SAME_KEY})"),
)
def merge_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.inserted_rows(*roles.branch_snapshots(spark, sf_dir), KEY)


@query(
    "merge_updates",
    sql(MERGE, f"SELECT s.* FROM staging_rows s JOIN main_rows t ON {SAME_KEY} WHERE {PRESENT} AND {CHANGED}"),
)
def merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.updated_rows(*roles.branch_snapshots(spark, sf_dir), KEY, DATA)


@query(
    "merge_deletes",
    sql(MERGE, f"SELECT t.* FROM main_rows t WHERE NOT EXISTS (SELECT 1 FROM staging_rows s WHERE {SAME_KEY})"),
)
def merge_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, staging = roles.branch_snapshots(spark, sf_dir)
    return M.deleted_rows(main, staging, KEY).select(*ESTABELECIMENTOS.columns)


@query("merge_again", sql(MERGED, "SELECT 0 AS inserted, 0 AS updated, 0 AS deleted, count(*) AS rows FROM merged "
                                  "WHERE op <> 'delete'"))
def merge_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging the same dump a second time changes nothing."""
    _, staging = roles.branch_snapshots(spark, sf_dir)
    after = M.snapshot(_merged(spark, sf_dir))
    again = M.three_way_merge(after, staging, KEY, DATA, "2026-04", "2026-04-01 00:00:00")
    return again.agg(
        *[F.count_if(F.col("op") == op).cast("int").alias(n) for op, n in (
            (M.INSERT, "inserted"), (M.UPDATE, "updated"), (M.DELETE, "deleted"))],
        F.count("*").alias("rows"),
    )


@query(
    "volume_guard",
    sql(
        MERGE, "SELECT m.n AS main_rows, s.n AS staging_rows, m.n = 0 OR s.n >= m.n * 0.5 AS passed FROM "
        "(SELECT count(*) AS n FROM main_rows) m, (SELECT count(*) AS n FROM staging_rows) s",
    ),
)
def volume_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.volume_guard(*roles.branch_snapshots(spark, sf_dir))


@query(
    "volume_guard_partial",
    "SELECT m.n AS main_rows, s.n AS staging_rows, m.n = 0 OR s.n >= m.n * 0.5 AS passed FROM "
    "(SELECT count(*) AS n FROM orders) m, (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F') s",
)
def volume_guard_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop with only the closed orders is too small."""
    orders = table(spark, sf_dir, "orders")
    return checks.volume_guard(orders, orders.filter("o_orderstatus = 'F'"))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("unique_keys", "SELECT o_orderkey, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) > 1")
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No rows: the key holds."""
    return checks.duplicate_keys(table(spark, sf_dir, "orders"), ["o_orderkey"])


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
_LINE_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, "
    "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem"
)


@query(
    "dedup_first",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, "
    f"l_partkey, l_suppkey, l_returnflag, l_linestatus) AS rn FROM ({_LINE_SQL})) WHERE rn = 1",
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(*_LINE, F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    return checks.keep_first(line, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "overlength_report",
    "SELECT p_partkey, 'p_name' AS field, p_name AS value, length(p_name) AS length, 10 AS max_length FROM part "
    "WHERE length(p_name) > 10 UNION ALL SELECT p_partkey, 'p_type', p_type, length(p_type), 6 FROM part "
    "WHERE length(p_type) > 6 UNION ALL SELECT p_partkey, 'p_brand', p_brand, length(p_brand), 7 FROM part "
    "WHERE length(p_brand) > 7",
)
def overlength_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return overlength(part, {"p_name": 10, "p_type": 6, "p_brand": 7}, ["p_partkey"])


@query(
    "replace_all",
    f"SELECT {zpad('c_custkey', 8)} AS cnpj_basico, c_name AS nome_socio, {zpad('c_nationkey', 2)} AS "
    f"qualificacao_socio, '{NEW_KEY}' AS run_key, '{NEW_STAMP}' AS created_at, '{NEW_STAMP}' AS updated_at FROM customer "
    f"UNION ALL SELECT CASE WHEN s_acctbal >= 0 THEN {zpad('s_suppkey', 8)} END, s_name, {zpad('s_nationkey', 2)}, "
    f"'{NEW_KEY}', '{NEW_STAMP}', '{NEW_STAMP}' FROM supplier",
)
def replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partners have no key: all rows are taken over, those without a company number, too."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    staging = roles.filled(
        customer, SOCIOS, cnpj_basico=zero_pad(F.col("c_custkey"), 8), nome_socio=F.col("c_name"),
        qualificacao_socio=zero_pad(F.col("c_nationkey"), 2),
    ).unionByName(
        roles.filled(
            supplier, SOCIOS, cnpj_basico=F.when(F.col("s_acctbal") >= 0, zero_pad(F.col("s_suppkey"), 8)),
            nome_socio=F.col("s_name"), qualificacao_socio=zero_pad(F.col("s_nationkey"), 2),
        )
    )
    new = M.replace_all(staging, SOCIOS.columns, NEW_KEY, NEW_STAMP, "id")
    return dated(
        new.select("cnpj_basico", "nome_socio", "qualificacao_socio", "run_key", "created_at", "updated_at"),
        "created_at", "updated_at",
    )


@query(
    "replace_key_present",
    f"SELECT * FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' WHEN c_acctbal >= 0 THEN {zpad('c_custkey', 8)} "
    f"END AS cnpj_basico, c_name, '{NEW_KEY}' AS run_key, '{NEW_STAMP}' AS updated_at FROM customer) "
    "WHERE NULLIF(trim(cnpj_basico), '') IS NOT NULL",
)
def replace_key_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "  ")
        .when(F.col("c_acctbal") >= 0, zero_pad(F.col("c_custkey"), 8)).alias("cnpj_basico"),
        "c_name",
    )
    return dated(
        M.replace_key_present(staging, ["cnpj_basico"], ["cnpj_basico", "c_name"], NEW_KEY, NEW_STAMP), "updated_at"
    )


@query("replace_lookup", f"SELECT {zpad('n_nationkey', 4)} AS codigo, n_name AS descricao FROM nation")
def replace_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.replace_lookup(roles.nation_codes(table(spark, sf_dir, "nation"), 4))


@query(
    "row_counts",
    "SELECT (SELECT count(*) FROM lineitem) AS main_rows, (SELECT count(*) FROM orders) AS staging_rows",
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_counts(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
