import pytest
from pyspark.sql import functions as F

from rollbook.operators import search as S, trigram
from rollbook.operators.checks import CheckFailed
from rollbook.operators.joins import decode, join_unique
from rollbook.plans.serving import SERVING_COLUMNS, build_serving, laid_out
from rollbook.sources.tables import TableFolder
from tests.helpers import plan_of, rows
from workload import roles


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return roles.registry_tables(spark, sf_dir)


@pytest.fixture(scope="module")
def view(spark, tables, tmp_path_factory):
    folder = TableFolder(spark, str(tmp_path_factory.mktemp("serving")))
    return folder.write("serving", "1", laid_out(build_serving(tables)), ["uf"])


def test_columns_and_key(view):
    assert len(SERVING_COLUMNS) == 49 and set(view.columns) == set(SERVING_COLUMNS)
    assert view.count() == view.select("cnpj_completo").distinct().count()


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.enabled": "true",
    # A partition is split by the tasks that wrote it, and tables this small are otherwise written by one.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_tasks(spark):
    """Sizes at which adaptive execution takes this data for large."""
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_company(spark, tables, sf_dir, small_tasks):
    """A third of all branches belong to one company: its rows are split over tasks."""
    branches = roles.skewed_branches(roles.table(spark, sf_dir, "orders").repartition(8))
    skewed = build_serving({**tables, "estabelecimentos": branches})
    assert skewed.filter("cnpj_basico = '00000001'").count() > skewed.count() / 4
    skewed.collect()
    assert "skew=true" in skewed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("salts", [1, 16])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique(spark, how, salts):
    facts = spark.createDataFrame([("a", i % 40) for i in range(50)] + [(None, 50), ("b", 51), ("c", 52)], "k string, i int")
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), (None, "N")], "k string, d string")
    got = join_unique(facts, dim, "k", how, salts)
    assert rows(got) == rows(facts.join(dim, "k", how)) and got.columns == ["k", "i", "d"]
    assert got.count() == (53 if how == "left" else 51)


def test_serving_needs_its_base_tables(tables):
    with pytest.raises(CheckFailed, match="empresas"):
        build_serving({**tables, "empresas": None})


@pytest.mark.parametrize("options", [{"salts": 4}, {"merge": True}])
def test_tables_that_grow_are_not_broadcast(spark, options):
    facts, dim = (spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias(c)) for c in ("v", "w"))
    joined = join_unique(facts, dim, "k", **options)
    joined.collect()
    assert "Broadcast" not in plan_of(joined)


def test_code_tables_are_broadcast_by_size_only(spark, tables):
    branch = tables["estabelecimentos"]
    small = decode(branch, "cnae_fiscal", tables["cnaes"], "d")
    assert "BroadcastHashJoin" in plan_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = decode(branch, "cnae_fiscal", tables["cnaes"], "d")
        assert "SortMergeJoin" in plan_of(large)
        expected = rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(small) == expected


def test_missing_tables_give_nulls(tables):
    few = build_serving({"empresas": tables["empresas"], "estabelecimentos": tables["estabelecimentos"]})
    assert few.columns == list(SERVING_COLUMNS)
    assert few.filter("porte_descricao is not null or opcao_pelo_simples is not null").isEmpty()


def test_lookup_is_pushed_to_the_scan(view):
    plan = plan_of(S.lookup(view, "00000001"))
    assert "PushedFilters: [Or(EqualTo(cnpj_completo,00000001),EqualTo(cnpj_basico,00000001))]" in plan


def test_search_reads_narrow_then_by_key(spark, view):
    plan = plan_of(S.search(view, razao_social="mer#0", uf="hi", limit=3))
    physical = plan.split("== Physical Plan ==")[1]
    assert "In(cnpj_completo, [" in physical and "TakeOrderedAndProject" in physical, physical
    assert "PartitionFilters: [isnotnull(uf" in physical, physical
    condition = S.search_condition(razao_social="mer#0", uf="hi")
    narrow = plan_of(view.filter(condition).select("cnpj_completo", "uf"))
    assert "ReadSchema: struct<cnpj_completo:string,razao_social:string,nome_fantasia:string>" in narrow
    assert S.search(view, cnae="nothing").count() == 0


def test_search_with_unknown_state(spark, view):
    some = view.withColumn("uf", F.when(F.col("uf") == "HI", F.lit(None)).otherwise(F.col("uf")))
    keys = rows(S.search(some, razao_social="r#0", limit=100), "cnpj_completo")
    expected = view.filter(S.search_condition(razao_social="r#0")).orderBy("cnpj_completo").limit(100)
    assert keys == rows(expected, "cnpj_completo")


def test_keys_as_typed(view):
    full = view.agg(F.min("cnpj_completo")).first()[0]
    typed = f"{full[:2]}.{full[2:5]}.{full[5:8]}/{full[8:12]}-{full[12:]}"
    assert S.lookup_one(view, typed)["cnpj_completo"] == full
    with pytest.raises(S.InvalidKey):
        S.lookup(view, "123")
    with pytest.raises(S.NotFound):
        S.lookup_one(view, "99999999999999")


@pytest.mark.parametrize(("asked", "given"), [(-5, 1), (0, 1), (20, 20), (1000, 100)])
def test_limits(asked, given):
    assert S.clamp_limit(asked) == given


def test_search_order_and_no_condition(view):
    keys = [r[0] for r in view.select("cnpj_completo").orderBy("cnpj_completo").limit(20).collect()]
    assert [r["cnpj_completo"] for r in S.search(view).collect()] == keys
    assert S.search_condition(razao_social="", uf=None) is None


def test_bulk_lookup_against_single_lookups(spark, view):
    some = [r[0] for r in view.select("cnpj_completo").limit(5).collect()]
    keys = [*some, *[k[:8] for k in some], "123", "99999999", "99999999999999", "a1b2", None]
    asked = spark.createDataFrame([(k,) for k in keys], "key string").distinct()
    got = {r["key"]: (r["status"], r["cnpj_completo"]) for r in S.bulk_lookup(view, asked).collect()}
    for key in set(keys):
        if key is None or len([c for c in key if c.isdigit()]) not in (8, 14):
            expected = ("invalid", None)
        else:
            row = S.lookup(view, key).first()
            expected = ("found", row["cnpj_completo"]) if row else ("not_found", None)
        assert got[key] == expected
    assert len(got) == len(set(keys))
    many = asked.unionByName(spark.range(300).select(F.lit(some[0]).alias("key")))
    assert S.bulk_lookup(view, many).count() == len(got) + 300
    physical = plan_of(S.bulk_lookup(view, many)).split("== Physical Plan ==")[1]
    assert not [line for line in physical.splitlines() if "SortAggregate" in line and "record" in line]
    assert "CartesianProduct" not in plan_of(S.bulk_lookup(view, asked))


def test_response_is_text(view):
    answer = S.response(view)
    assert answer.schema == S.RESPONSE_SCHEMA
    assert answer.first()["updated_at"] == "2026-02-01T00:00:00+00:00"
    stamps = view.limit(1).withColumn("updated_at", F.expr("timestamp_ntz'2026-02-01 10:11:12.345678'"))
    assert S.response(stamps).first()["updated_at"] == "2026-02-01T10:11:12.345678"
    zoned = stamps.withColumn("updated_at", F.expr("timestamp'2026-02-01 10:11:12.345678+02:00'"))
    assert S.response(zoned).first()["updated_at"] == "2026-02-01T08:11:12.345678+00:00"
    assert S.response(view.drop("uf")).filter("uf is not null").isEmpty()


@pytest.mark.parametrize("text", ["mer#0", "MEDIUM", "T S", "aaa", "9", "_-n", "100%", "r#00000000", "-NOT "])
def test_trigram_search_equals_scan(spark, view, text, tmp_path):
    columns = ["razao_social", "nome_fantasia"]
    index = trigram.build_index(view.select("cnpj_completo", *columns), "cnpj_completo", columns)
    if text == "mer#0":
        trigram.write_index(index, str(tmp_path / "ix"))
        index = spark.read.parquet(str(tmp_path / "ix"))
    found = trigram.search_indexed(view, index, "cnpj_completo", columns, text).select("cnpj_completo")
    scan = view.filter(S.search_condition(razao_social=text)).select("cnpj_completo")
    assert rows(found) == rows(scan)


def test_candidates_are_joined_in_one_lazy_plan(spark, view):
    index = trigram.build_index(view.select("cnpj_completo", "razao_social"), "cnpj_completo", ["razao_social"])
    few = trigram.search_indexed(view, index, "cnpj_completo", ["razao_social"], "0000149")
    many = trigram.search_indexed(view, index, "cnpj_completo", ["razao_social"], "customer")
    assert "LeftSemi" in plan_of(few) and "LeftSemi" in plan_of(many)
    assert few.count() > 0 and many.count() == view.count()


def test_trigrams_of_short_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ABcab"), (3, None), (4, ""), (5, "a\nb😀c")], "id int, t string")
    got = {r["id"]: r["p"] for r in df.select("id", trigram.trigrams(F.col("t")).alias("p")).collect()}
    assert not got[1] and got[3] is None and not got[4]
    assert sorted(got[2]) == ["abc", "bca", "cab"]
    assert got[5] == ["a\nb", "\nb😀", "b😀c"]


def test_branches_stream_past_their_companies(spark, tables, small_tasks):
    """No task sorts the branches for the company join, whose size is that of its largest company."""
    served = build_serving(tables)
    served.collect()
    plan = served._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [cnpj_basico" in line and "Inner" in line]
    assert joins and all("ShuffledHashJoin" in line for line in joins)
