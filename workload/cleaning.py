"""Cleaning rules, raw files, typed readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.functions import typed
from rollbook.operators import cleaning as C
from rollbook.operators.ledger import totals
from rollbook.session import work_dir
from rollbook.sources import raw_files
from rollbook.sources.registry import EMPRESAS, ESTABELECIMENTOS, LOOKUP, Layout
from rollbook.sources.tables import TableFolder, replace_partitions
from workload import roles
from workload.catalog import query
from workload.oracle import CLEAN, cleaned, sql
from workload.roles import table

_ALL = list(EMPRESAS.columns)
_EMPTY = "COALESCE(" + ", ".join(_ALL) + ") IS NULL"
_STATE = (
    f"CASE WHEN {_EMPTY} THEN 'empty' WHEN cnpj_basico IS NULL THEN 'missing_required' ELSE 'kept' END"
)
_METRICS = (
    "count(*) FILTER (row_state = 'kept') AS rows, count(*) FILTER (row_state = 'empty') AS skipped_empty, "
    "count(*) FILTER (row_state = 'missing_required') AS skipped_invalid_required"
)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.raw_companies(table(spark, sf_dir, "customer"))


@query("clean_cells", sql(CLEAN, "SELECT * FROM clean_companies"))
def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_cells(_raw(spark, sf_dir))


@query(
    "clean_cells_exempt",
    sql(
        "raw_companies", "SELECT "
        + ", ".join(
            f"CASE WHEN {c} IS NOT NULL THEN NULLIF(trim({c}, ' ' || chr(9) || chr(160)), '') END AS {c}"
            if c in ("cnpj_basico", "porte") else f"{cleaned(c)} AS {c}" for c in _ALL
        ) + " FROM raw_companies",
    ),
)
def clean_cells_exempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and size code keep what elsewhere counts as "no value"."""
    return C.clean_cells(_raw(spark, sf_dir), null_exempt_columns=["cnpj_basico", "porte"])


@query("clean_documents", f"SELECT doc_id, md5(COALESCE({cleaned('text')}, '')) AS digest, source FROM documents")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell rule on long texts."""
    docs = C.clean_cells(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["text"])
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "source")


@query("drop_empty", sql(CLEAN, f"SELECT * FROM clean_companies WHERE NOT ({_EMPTY})"))
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_empty(C.clean_cells(_raw(spark, sf_dir)))


@query("drop_missing_required", sql(CLEAN, "SELECT * FROM clean_companies WHERE cnpj_basico IS NOT NULL"))
def drop_missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_table(_raw(spark, sf_dir), EMPRESAS)


@query("clean_metrics", sql(CLEAN, f"SELECT {_METRICS} FROM (SELECT {_STATE} AS row_state FROM clean_companies)"))
def clean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_metrics(C.classify_rows(C.clean_cells(_raw(spark, sf_dir)), EMPRESAS.columns, EMPRESAS.required))


@query(
    "metrics_totals",
    sql(
        CLEAN, "SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(skipped_empty) AS BIGINT) AS total_skipped_empty, "
        "CAST(sum(skipped_invalid_required) AS BIGINT) AS total_skipped_invalid_required FROM "
        f"(SELECT {_METRICS} FROM (SELECT {_STATE} AS row_state FROM clean_companies) "
        "UNION ALL SELECT count(*), 0, 0 FROM orders)",
    ),
)
def metrics_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of two tables added up."""
    first = clean_metrics(spark, sf_dir)
    branches = C.clean_cells(roles.estabelecimentos(table(spark, sf_dir, "orders")), null_exempt_columns=["cnpj_basico"])
    second = C.clean_metrics(C.classify_rows(branches, ESTABELECIMENTOS.columns, ESTABELECIMENTOS.required))
    return totals(first.unionByName(second), ["rows", "skipped_empty", "skipped_invalid_required"])


@query("bad_key_count", sql("raw_companies", "SELECT count(*) AS bad_rows FROM raw_companies WHERE "
                            "trim(COALESCE(cnpj_basico, ''), ' ' || chr(9)) = ''"))
def bad_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = C.clean_cells(_raw(spark, sf_dir), ["cnpj_basico"], ["cnpj_basico"])
    return C.blank_key_count(stripped, "cnpj_basico")


@query(
    "bad_key_samples",
    sql(
        CLEAN, "SELECT razao_social, natureza_juridica, capital_social FROM clean_companies WHERE cnpj_basico IS NULL "
        "AND razao_social IS NOT NULL ORDER BY razao_social LIMIT 5",
    ),
)
def bad_key_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report shows five rows without a key."""
    rows = C.drop_empty(C.clean_cells(_raw(spark, sf_dir)))
    return C.blank_key_samples(rows, "cnpj_basico", ["razao_social"]).select(
        "razao_social", "natureza_juridica", "capital_social"
    )


@query(
    "typed_fields",
    "SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS opened, CAST(NULL AS VARCHAR) AS not_a_date, "
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS capital, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS closed "
    "FROM orders",
)
def typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields read as date, money and flag."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("other"),
        F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("money"),
        F.when(F.col("o_orderstatus") == "F", "S").when(F.col("o_orderstatus") == "O", "N").otherwise("?").alias("flag"),
    )
    return text.select(
        "o_orderkey",
        F.date_format(typed.compact_date(F.col("day")), "dd.MM.yyyy").alias("opened"),
        F.date_format(typed.compact_date(F.col("other")), "dd.MM.yyyy").alias("not_a_date"),
        typed.comma_money(F.col("money")).cast("string").alias("capital"),
        typed.yes_no(F.col("flag")).cast("string").alias("closed"),
    )


DOCUMENTS = Layout("documents", ("doc_id", "lang", "source", "text", "missing"), ("docs",), LOOKUP, ("doc_id",))


@query(
    "raw_multiline_roundtrip",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, md5({cleaned('text')}) AS digest, "
    f"length({cleaned('text')}) AS n, CAST(NULL AS VARCHAR) AS missing FROM documents",
)
def raw_multiline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and line breaks through the raw form; the rows are one field short."""
    path = work_dir(spark, "raw-documents")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "lang", "source", "text")
    raw_files.write_raw(docs, path)
    paths = [r["path"] for r in raw_files.list_files(spark, path).filter("name like 'part-%'").collect()]
    rows = C.clean_table(raw_files.scan_raw(spark, paths, DOCUMENTS), DOCUMENTS, ["doc_id"])
    return rows.select("doc_id", "lang", "source", F.md5("text").alias("digest"), F.length("text").alias("n"), "missing")


NOTES = Layout("notes", ("key", "text", "extra"), ("notes",), LOOKUP, ("key",))
_PER_FILE = 30_000
_NOTE = """'say "' || l_returnflag || '"; line ' || l_orderkey || chr(10) || repeat('cargo; ', 30) || l_linenumber"""
# Every row is a record of two lines; after each seventh order's first line comes a blank one.
_NOTE_ROWS = f"""
note_rows AS (
  SELECT l_orderkey // {_PER_FILE} AS file, CASE WHEN l_partkey % 50 = 0 THEN ' ' ELSE l_orderkey || '-' || l_linenumber END AS key, {_NOTE} AS text,
         (l_orderkey % 7 = 0 AND l_linenumber = 1)::INT AS blank, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
), noted AS (
  SELECT *, row_number() OVER w + sum(blank) OVER w - blank AS record, 2 * row_number() OVER w - 1 + sum(blank) OVER w - blank AS line
  FROM note_rows WINDOW w AS (PARTITION BY file ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)
)"""


def _notes(spark: SparkSession, sf_dir: str) -> str:
    """Raw files of so many orders each, their records in order."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    said = F.concat(F.lit('say "'), "l_returnflag", F.lit('"; line '), F.col("l_orderkey").cast("string"))
    cargo = F.concat(F.lit("\n" + "cargo; " * 30), F.col("l_linenumber").cast("string"))
    key = F.when(F.col("l_partkey") % 50 == 0, " ").otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber"))
    record = F.concat(key, F.lit(';"'), F.replace(said, F.lit('"'), F.lit('""')), cargo, F.lit('";x'))
    file = F.floor(F.col("l_orderkey") / _PER_FILE)
    blank = F.when((F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") == 1), F.lit("\n")).otherwise("")
    # Records are put together after the shuffle: only what they are made of crosses it.
    rows = line.repartition(file).withColumn("file", file).sortWithinPartitions("file", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    path = work_dir(spark, "raw-notes")
    rows.select(F.concat(record, blank).alias("value"), "file").write.partitionBy("file").text(path)
    return path


def _file_number(path: Column) -> Column:
    return F.regexp_extract(path, "file=([0-9]+)/", 1).cast("bigint")


@query("raw_records", f"WITH {_NOTE_ROWS} SELECT file, CAST(record AS BIGINT) AS record, CAST(line AS BIGINT) AS line, key, md5(text) AS digest, 'x' AS extra FROM noted")
def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of files larger than a split whose fields span lines, with their numbers in the file."""
    rows = raw_files.numbered_rows(spark, [_notes(spark, sf_dir)], NOTES)
    return rows.select(_file_number(F.col("source_path")).alias("file"), "record", "line", "key", F.md5("text").alias("digest"), "extra")


@query("raw_blank_lines", f"WITH {_NOTE_ROWS} SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(blank) AS BIGINT) AS blank_lines FROM noted")
def raw_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank lines of such files are counted, and are not rows."""
    rows, blank = raw_files.scan_counted(spark, [_notes(spark, sf_dir)], NOTES)
    return rows.agg(F.count("*").alias("rows"), F.lit(blank).cast("bigint").alias("blank_lines"))


@query("bad_key_lines", f"WITH {_NOTE_ROWS} SELECT file, CAST(record AS BIGINT) AS record, CAST(line AS BIGINT) AS line, md5(text) AS digest FROM noted WHERE key = ' ' ORDER BY file, record LIMIT 5")
def bad_key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's five rows without a key, with file, record and line."""
    rows = raw_files.blank_key_lines(spark, [_notes(spark, sf_dir)], NOTES, "key")
    rows = rows.select(_file_number(F.col("source_path")).alias("file"), "record", "line", F.md5("text").alias("digest"))
    return rows.orderBy("file", "record").limit(5)


_TUBE = """p_name || ' 5" tube'"""


@query(
    "raw_folder_roundtrip",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, md5({cleaned('text')}) AS digest, "
    f"length({cleaned('text')}) AS n FROM documents UNION ALL "
    f"SELECT 'p' || CAST(p_partkey AS VARCHAR), NULL, NULL, md5({cleaned(_TUBE)}), length({cleaned(_TUBE)}) FROM part",
)
def raw_folder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of raw files: texts with quoted line breaks, and names with a quote that opens nothing."""
    texts, names = work_dir(spark, "raw-texts"), work_dir(spark, "raw-names")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "lang", "source", "text")
    raw_files.write_raw(docs, texts)
    lines = F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(";;;"), "p_name", F.lit(' 5" tube'))
    table(spark, sf_dir, "part").select(lines).write.text(names)
    rows = C.clean_table(raw_files.scan_raw(spark, [texts, names], DOCUMENTS), DOCUMENTS, ["doc_id"])
    return rows.select("doc_id", "lang", "source", F.md5("text").alias("digest"), F.length("text").alias("n"))


@query(
    "raw_file_profile",
    "SELECT 'orders' AS kind, count(*) AS lines, 0 AS blank_lines, 0 AS odd_quote_lines FROM orders",
)
def raw_file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scan looks at to decide how a file can be read."""
    path = work_dir(spark, "raw-orders")
    raw_files.write_raw(roles.estabelecimentos(table(spark, sf_dir, "orders")), path)
    return raw_files.raw_profile(spark, [path]).agg(
        F.lit("orders").alias("kind"), F.sum("lines").alias("lines"),
        F.sum("blank_lines").cast("int").alias("blank_lines"), F.sum("odd_quote_lines").cast("int").alias("odd_quote_lines"),
    )


@query(
    "raw_csv_roundtrip",
    sql(
        "estabelecimentos", "SELECT * FROM estabelecimentos WHERE cnpj_basico <> '00000000'",
    ),
)
def raw_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches through the raw form; the all-zero key is a "no value" marker and goes."""
    path = work_dir(spark, "raw-branches")
    raw_files.write_raw(roles.estabelecimentos(table(spark, sf_dir, "orders")), path)
    return C.clean_table(raw_files.scan_raw(spark, [path], ESTABELECIMENTOS), ESTABELECIMENTOS)


@query("headered_csv", sql("empresas", "SELECT * FROM empresas"))
def headered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "headered")
    raw_files.write_headered(roles.empresas(table(spark, sf_dir, "customer")), path)
    return raw_files.scan_headered(spark, path, multi_line=False)


@query(
    "source_match",
    "SELECT table_name, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM (SELECT n_chars, unnest(CASE lang "
    "WHEN 'en' THEN ['empresas'] WHEN 'fr' THEN ['estabelecimentos'] WHEN 'de' THEN ['cnaes', 'simples'] "
    "ELSE [] END) AS table_name FROM documents WHERE source <> 'src4') GROUP BY 1",
)
def source_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names matched with tables by alias; unfinished files are passed over."""
    name = F.concat(
        F.when(F.col("lang") == "en", "K3241.D").when(F.col("lang") == "fr", "k.").when(F.col("lang") == "de", "F.CnaeCSV$")
        .otherwise("notes."),
        F.col("doc_id").cast("string"),
        F.when(F.col("lang") == "en", ".EMPRECSV").when(F.col("lang") == "fr", ".estabele")
        .when(F.col("lang") == "de", ".SIMPLES.CSV").otherwise(".txt"),
        F.when(F.col("source") == "src4", ".tmp").otherwise(""),
    )
    listed = table(spark, sf_dir, "documents").select(name.alias("name"), F.col("n_chars").alias("length"))
    return raw_files.match_sources(listed).groupBy(F.col("table").alias("table_name")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


@query(
    "curated_write",
    sql(CLEAN, f"SELECT *, {_STATE} AS row_state FROM clean_companies"),
)
def curated_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row written once with its state, read back."""
    folder = TableFolder(spark, work_dir(spark, "curated"))
    classified = C.classify_rows(C.clean_cells(_raw(spark, sf_dir)), EMPRESAS.columns, EMPRESAS.required)
    return folder.write("curated/empresas", "2026-03", classified, ["row_state"])


@query(
    "partition_replace",
    "SELECT strftime(o_orderdate, '%Y') AS run_key, o_orderkey, CASE WHEN strftime(o_orderdate, '%Y') = '1998' THEN 'new' "
    "ELSE 'old' END AS state FROM orders",
)
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run key loaded again replaces its own rows and no others."""
    path = work_dir(spark, "by-run-key")
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy").alias("run_key"), "o_orderkey")
    replace_partitions(orders.withColumn("state", F.lit("old")), path)
    for _ in range(2):
        replace_partitions(orders.filter("run_key = '1998'").withColumn("state", F.lit("new")), path)
    return spark.read.schema("o_orderkey bigint, state string, run_key string").parquet(path)


@query(
    "publish_swap",
    "SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS before_rows, (SELECT count(*) FROM orders) AS "
    "after_rows, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS old_reader_rows, 2 AS publications",
)
def publish_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader of the old version keeps it; new readers see the new one once it is published."""
    folder = TableFolder(spark, work_dir(spark, "versions"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for run_key, rows in (("2026-02", orders.filter("o_orderstatus = 'F'")), ("2026-03", orders)):
        version = folder.new_version(run_key)
        folder.write("orders", version, rows)
        if run_key == "2026-03":
            old_reader = folder.current("orders")
            before = old_reader.agg(F.count("*").alias("before_rows"))
            before = before.first()["before_rows"]
        folder.publish({"orders": version}, run_key)
    after = folder.current("orders").agg(F.count("*").alias("after_rows"))
    return after.select(
        F.lit(before).cast("bigint").alias("before_rows"), "after_rows",
        F.lit(old_reader.count()).cast("bigint").alias("old_reader_rows"),
        F.lit(folder.publications().count()).cast("int").alias("publications"),
    )
