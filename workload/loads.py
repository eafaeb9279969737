"""Whole loads and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.operators import checks
from rollbook.operators.ledger import step_rollup
from rollbook.plans import monthly
from rollbook.plans.serving import build_serving
from rollbook.session import work_dir
from rollbook.sources import raw_files
from rollbook.sources.registry import ESTABELECIMENTOS, LAYOUTS
from rollbook.sources.run_events import RunEvents
from rollbook.sources.tables import TableFolder
from rollbook.streaming.drops import watch_drops
from rollbook.streaming.status import keep_latest, latest_rows, live_rollup
from workload import roles
from workload.catalog import query
from workload.ledger import _ROLLUP, ORDER, times
from workload.oracle import MERGED, NEW_KEY, NEW_STAMP, OLD_KEY, OLD_STAMP, STAR, sql
from workload.roles import table
from workload.serving import dated


def _raw_drop(spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Write tables in raw form; returns the folder of each."""
    root = work_dir(spark, "raw-drop")
    for name, df in tables.items():
        raw_files.write_raw(df.select(*LAYOUTS[name].columns), f"{root}/{name}")
    return {name: [f"{root}/{name}"] for name in tables}


_NO_ZERO = "SELECT * FROM star WHERE cnpj_basico <> '00000000'"


@query("monthly_load", sql(STAR, _NO_ZERO))
def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first drop from raw files to the serving table."""
    sources = _raw_drop(spark, sf_dir, roles.registry_tables(spark, sf_dir))
    root = work_dir(spark, "registry")
    monthly.run_load(spark, root, "", monthly.Options(OLD_KEY, OLD_STAMP, layouts=roles.ROLE_LAYOUTS), sources=sources)
    return dated(monthly.serving_rows(TableFolder(spark, root)), "updated_at")


@query(
    "monthly_load_events",
    sql(
        STAR, "SELECT 'empresas' AS name, 'inserted' AS what, count(*) AS n FROM empresas WHERE cnpj_basico <> '00000000' UNION ALL "
        "SELECT 'estabelecimentos', 'inserted', count(*) FROM estabelecimentos WHERE cnpj_basico <> '00000000' UNION ALL "
        "SELECT 'simples', 'inserted', count(*) FROM simples WHERE cnpj_basico <> '00000000' UNION ALL "
        "SELECT 'serve', 'served', count(*) FROM star WHERE cnpj_basico <> '00000000' UNION ALL "
        "SELECT unnest(['load', 'run', 'serve', 'transform']), 'SUCCESS', 1",
    ),
)
def monthly_load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the load reports them, and how often each step ran: running it again skips every step."""
    sources = _raw_drop(spark, sf_dir, roles.registry_tables(spark, sf_dir))
    root = work_dir(spark, "registry")
    for _ in range(2):
        monthly.run_load(spark, root, "", monthly.Options(OLD_KEY, OLD_STAMP, layouts=roles.ROLE_LAYOUTS), sources=sources)
    steps = step_rollup(RunEvents(spark, f"{root}/run_events").read())
    loaded = spark.read.schema(monthly.LOAD_SCHEMA).json(f"{root}/metrics/load/run_key={OLD_KEY}")
    tables = loaded.filter(F.col("table").isin("empresas", "estabelecimentos", "simples"))
    served = steps.filter("step_name = 'serve'").select("step_name", F.lit("served"), F.col("artifact_path").cast("bigint"))
    return (
        tables.select(F.col("table").alias("name"), F.lit("inserted").alias("what"), F.col("inserted").alias("n"))
        .union(served).union(steps.select("step_name", "status", "runs"))
    )


@query("stream_merge", sql(MERGED, "SELECT * FROM merged WHERE cnpj_basico <> '00000000' AND op <> 'delete'"))
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops loaded as their completion notes come in."""
    main, staging = roles.branch_snapshots(spark, sf_dir)
    drops = work_dir(spark, "drops")
    notes, root = f"{drops}/notes", work_dir(spark, "registry")
    layouts = {ESTABELECIMENTOS.name: roles.BRANCHES}
    folder = TableFolder(spark, root)

    def handle(run_key: str, raw: str) -> None:
        options = monthly.Options(run_key, OLD_STAMP if run_key == OLD_KEY else NEW_STAMP, layouts=layouts)
        monthly.transform(spark, folder, {ESTABELECIMENTOS.name: [raw]}, options)
        monthly.load(spark, folder, options)

    for run_key, df in ((OLD_KEY, main), (NEW_KEY, staging)):
        raw = f"{drops}/{run_key}"
        raw_files.write_raw(df.select(*ESTABELECIMENTOS.columns), raw)
        spark.createDataFrame([(run_key, raw)], "run_key string, folder string").coalesce(1).write.mode("append").json(notes)
        watch_drops(spark, notes, f"{drops}/checkpoint", handle).awaitTermination()
    current = folder.current(ESTABELECIMENTOS.name, monthly.current_schema(ESTABELECIMENTOS)).filter("op <> 'delete'")
    return dated(current, "created_at", "updated_at")


_CHANGED_FEW = (
    f"SELECT * REPLACE (CASE WHEN CAST(cnpj_basico AS BIGINT) % 40 = 3 AND situacao_cadastral = 'O' THEN 'F' ELSE situacao_cadastral END AS situacao_cadastral) "
    "FROM estabelecimentos WHERE NOT (CAST(cnpj_basico AS BIGINT) % 40 = 3 AND situacao_cadastral = 'P')"
)


@query(
    "merge_changed_buckets",
    sql(
        "estabelecimentos", f", staging_few AS ({_CHANGED_FEW}) SELECT e.cnpj_basico, e.cnpj_ordem, e.cnpj_dv, coalesce(s.situacao_cadastral, e.situacao_cadastral) AS situacao_cadastral, "
        "CASE WHEN s.cnpj_basico IS NULL THEN 'delete' WHEN s.situacao_cadastral <> e.situacao_cadastral THEN 'update' ELSE 'keep' END AS op, "
        f"CASE WHEN s.situacao_cadastral <> e.situacao_cadastral THEN '{NEW_KEY}' ELSE '{OLD_KEY}' END AS run_key "
        "FROM estabelecimentos e LEFT JOIN staging_few s ON s.cnpj_basico = e.cnpj_basico AND s.cnpj_ordem = e.cnpj_ordem AND s.cnpj_dv = e.cnpj_dv "
        "WHERE e.cnpj_basico <> '00000000'",
    ),
)
def merge_changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load that changes one company in forty: the other buckets stay where the first load wrote them."""
    main = roles.estabelecimentos(table(spark, sf_dir, "orders"))
    few = F.col("cnpj_basico").cast("bigint") % 40 == 3
    state = F.col("situacao_cadastral")
    staging = main.filter(~(few & (state == "P"))).withColumn("situacao_cadastral", F.when(few & (state == "O"), "F").otherwise(state))
    folder, layouts = TableFolder(spark, work_dir(spark, "registry")), {ESTABELECIMENTOS.name: roles.BRANCHES}
    for run_key, stamp, df in ((OLD_KEY, OLD_STAMP, main), (NEW_KEY, NEW_STAMP, staging)):
        options = monthly.Options(run_key, stamp, layouts=layouts)
        sources = _raw_drop(spark, sf_dir, {ESTABELECIMENTOS.name: df})
        monthly.transform(spark, folder, sources, options)
        monthly.load(spark, folder, options)
    current = folder.current(ESTABELECIMENTOS.name, monthly.current_schema(ESTABELECIMENTOS))
    return current.select(*ESTABELECIMENTOS.key, "situacao_cadastral", "op", "run_key")


#: Files of a micro-batch of ``stream_rollup``, so that as many tasks write and read it.
BATCH_FILES = 16


@query("stream_rollup", sql("run_events", _ROLLUP.format(source="run_events")))
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step rollup kept up to date by a stream of events in three micro-batches of many files: state is carried on."""
    root = work_dir(spark, "rollup")
    events = table(spark, sf_dir, "events")
    events.repartition(3 * BATCH_FILES, "event_id").write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(f"{root}/events")
    rollup = live_rollup(roles.run_events(stream), ORDER)
    keep_latest(rollup, f"{root}/batches", f"{root}/checkpoint").awaitTermination()
    return times(latest_rows(spark.read.parquet(f"{root}/batches")).drop("first_write"))


@query(
    "dry_run",
    sql("estabelecimentos", "SELECT 'estabelecimentos' AS table, count(*) FILTER (cnpj_basico <> '00000000') AS rows, count(*) FILTER (cnpj_basico = '00000000') AS skipped_invalid_required, 0 AS published FROM estabelecimentos"),
)
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run stops after cleaning: it counts rows and publishes nothing."""
    sources = _raw_drop(spark, sf_dir, {"estabelecimentos": roles.estabelecimentos(table(spark, sf_dir, "orders"))})
    root = work_dir(spark, "registry")
    monthly.run_load(spark, root, "", monthly.Options(OLD_KEY, OLD_STAMP, layouts=roles.ROLE_LAYOUTS), sources=sources, dry_run=True)
    counted = spark.read.schema(monthly.METRIC_SCHEMA).json(f"{root}/metrics/transform/run_key={OLD_KEY}").filter("files > 0")
    published = len(TableFolder(spark, root).current_versions())
    return counted.select("table", "rows", "skipped_invalid_required", F.lit(published).alias("published"))


@query(
    "unknown_table",
    sql("estabelecimentos", "SELECT 'estabelecimentos' AS table, count(*) AS inserted FROM estabelecimentos WHERE cnpj_basico <> '00000000'"),
)
def unknown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of no table are passed over; the others are loaded."""
    sources = _raw_drop(spark, sf_dir, {"estabelecimentos": roles.estabelecimentos(table(spark, sf_dir, "orders"))})
    folder, options = TableFolder(spark, work_dir(spark, "registry")), monthly.Options(OLD_KEY, OLD_STAMP, layouts=roles.ROLE_LAYOUTS)
    monthly.transform(spark, folder, sources, options)
    return monthly.load(spark, folder, options, ["nonsense", "estabelecimentos", "Empresas "]).select("table", "inserted")


@query(
    "empty_serving_guard",
    sql(
        STAR, "SELECT 'all' AS companies, count(*) AS rows, count(*) > 0 AS passed FROM star UNION ALL "
        "SELECT 'none with branches', 0, false",
    ),
)
def empty_serving_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving table without rows is refused: here that of companies none of which has a branch."""
    tables = roles.registry_tables(spark, sf_dir)
    lone = {**tables, "empresas": tables["empresas"].join(tables["estabelecimentos"].select("cnpj_basico"), "cnpj_basico", "left_anti")}
    answers = None
    for name, given in (("all", tables), ("none with branches", lone)):
        rows = build_serving(given)
        try:
            checks.require_rows(rows, "serving")
            passed = True
        except checks.CheckFailed:
            passed = False
        answer = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("companies"), "rows", F.lit(passed).alias("passed"))
        answers = answer if answers is None else answers.unionByName(answer)
    return answers
