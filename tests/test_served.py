"""What is published beside the serving rows: same answers as a scan, and less read."""

import random

import pytest

from rollbook.operators import partners, search as S, trigram
from rollbook.operators.zorder import z_ordered
from rollbook.plans import served as P
from rollbook.plans.serving import build_serving
from rollbook.sources.tables import TableFolder
from tests.helpers import plan_of, rows
from workload import roles
from workload.served import _partner_tables


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    folder = TableFolder(spark, str(tmp_path_factory.mktemp("served")))
    wide = build_serving(roles.registry_tables(spark, sf_dir))
    folder.publish(P.write_served(folder, "1", wide, group_bytes=2000), "2026-02")
    return folder


@pytest.fixture(scope="module")
def served(folder):
    return P.Served(folder)


def scanned(df) -> dict[str, int]:
    """Metrics of the one scan of a plan that has been run: files, and rows that left it."""
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = [plan.collectLeaves().apply(k) for k in range(plan.collectLeaves().size())]
    scans = []
    for leaf in leaves:
        while leaf.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage")):
            leaf = leaf.plan().collectLeaves().head()
        if "Scan" in leaf.nodeName():
            scans.append({m: leaf.metrics().apply(m).value() for m in ("numFiles", "numOutputRows", "numPartitions") if leaf.metrics().contains(m)})
    assert len(scans) == 1
    return scans[0]


def test_a_lookup_reads_one_folder(served):
    total = served.rows.count()
    keys = [r[0] for r in served.filters.select(P.KEY).orderBy(P.KEY).limit(500).collect()[::100]]
    for key in keys:
        for asked, condition in ((key, f"cnpj_completo = '{key}'"), (key[:8], f"cnpj_basico = '{key[:8]}'")):
            found = served.lookup(asked)
            assert found.collect()[0]["cnpj_basico"] == key[:8]
            one = served.in_folders([asked]).filter(condition)
            metrics = scanned(one)
            assert metrics["numPartitions"] == 1 and metrics["numOutputRows"] < total / 20
            assert rows(found, *found.columns) == rows(S.lookup(served.rows, asked), *found.columns)


@pytest.mark.parametrize(("condition", "most"), [
    ("cnae_fiscal = '0000011'", 0.75), ("municipio = '0005'", 0.75), ("situacao_cadastral = 'P'", 0.75),
])
def test_each_filter_alone_skips_row_groups(served, condition, most):
    total = served.filters.count()
    found = served.filters.filter(condition)
    assert 0 < found.count() and scanned(found)["numOutputRows"] < most * total


def test_z_order_serves_each_column(spark, tmp_path):
    wide = spark.range(60_000).selectExpr("id", "id * 7919 % 97 AS a", "if(id % 3 = 0, null, cast(id * 104729 % 501 as string)) AS b", "id * 31 % 5 AS c")
    z_ordered(wide, ["a", "b", "c"], "id").write.option("parquet.block.size", 4000).parquet(str(tmp_path / "z"))
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.count() == 60_000 and back.agg({"id": "sum"}).first()[0] == 60_000 * 59_999 // 2
    for condition in ("a = 50", "b = '77'", "c = 3"):
        assert back.filter(condition).count() == wide.filter(condition).count()
        assert scanned(back.filter(condition))["numOutputRows"] < 0.5 * 60_000, condition


def test_bloom_filters_are_written(spark, tmp_path, folder):
    """Files with a bloom filter are larger by it; Spark has no other sign of it."""
    sizes = []
    for name, options in (("with", {f"parquet.bloom.filter.enabled#{P.KEY}": "true"}), ("without", {})):
        folder.read(P.SERVING, "1").coalesce(1).write.options(**options).parquet(str(tmp_path / name))
        sizes.append(sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet")))
    assert sizes[0] > sizes[1] + 1000
    assert spark.read.parquet(folder.path(P.SERVING, "1")).select("key_part").distinct().count() > 50


def test_search_equals_a_scan(served):
    rng = random.Random(3)
    names = [r[0] for r in served.rows.select("razao_social").distinct().collect()] + [r[0] for r in served.rows.select("nome_fantasia").distinct().collect()]
    for k in range(14):
        name = rng.choice(names)
        start = rng.randrange(len(name) - 4)
        given = {"razao_social": name[start : start + rng.randrange(2, 9)].swapcase()}
        if k % 3 == 0:
            given["uf"] = rng.choice(["hi", "UR", "M"])
        if k % 4 == 0:
            given["situacao"] = rng.choice("FOP")
        given["limit"] = rng.choice([1, 7, 100])
        found, want = served.search(**given), S.search(served.rows, **given)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()], given
    for given in ({"municipio": "nation_2", "cnae": "0000007"}, {"uf": "hi"}, {"razao_social": "a%b"}, {"razao_social": "zz"}, {"municipio": "nowhere"}):
        assert rows(served.search(**given)) == rows(S.search(served.rows, **given)), given


def test_candidates_that_fail_the_other_conditions_are_passed_over(served, monkeypatch):
    monkeypatch.setattr(P, "SELECTIVE", 1)
    monkeypatch.setattr(P, "ROUNDS", 1)
    given = {"razao_social": "customer#", "situacao": "P", "limit": 5}
    assert [tuple(r) for r in served.search(**given).collect()] == [tuple(r) for r in S.search(served.rows, **given).collect()]


def test_side_tables_of_another_version_are_not_used(spark, folder, served):
    versions = {**folder.current_versions(), P.NAMES: "0", P.FILTERS: "0"}
    old = P.Served(folder, versions)
    assert old.names is None and old.filters is None
    assert rows(old.search(razao_social="000012", cnae="0000011")) == rows(served.search(razao_social="000012", cnae="0000011"))
    assert len({v for t, v in folder.current_versions().items()}) == 1 and folder.publications().select("published_at").distinct().count() == 1


def test_partners_are_not_shuffled(spark, sf_dir):
    people, regimes = _partner_tables(spark, sf_dir)
    # without broadcasts, as for tables that are too large for one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, every = partners.partners_of(people, regimes, ["00000007"]), partners.with_regime(people, regimes)
        assert "Exchange" not in plan_of(one) and "Exchange" not in plan_of(every)
        assert "SelectedBucketsCount: 1 out of 64" in plan_of(one)
        assert rows(every.filter("cnpj_basico = '00000007'")) == rows(one) and one.count() == 2
        assert rows(partners.with_regime(people, regimes, salted=True)) == rows(every)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(S.InvalidKey):
        partners.partners_of(people, regimes, ["7"])


def test_posting_lists_grow_with_names_not_rows(served):
    """A name that many rows have is cut into pieces once; the counts are those of rows."""
    names = sum(served.rows.select(c).distinct().count() for c in P.NAME_COLUMNS)
    assert served.names.select("field", "name").distinct().count() == names < served.rows.count()
    assert served.names.count() == served.names.select("field", "trigram", "name").distinct().count()
    piece = served.pieces.filter("field = 'razao_social' AND trigram = 'cus'").first()["rows"]
    assert piece == served.rows.filter("razao_social ILIKE '%cus%'").count()
    for text in ("R#0000000", "urgent f", "xyzzy", "zz"):
        found = trigram.search_names(served.rows, trigram.build_name_index(served.rows, P.NAME_COLUMNS), P.NAME_COLUMNS, text)
        assert rows(found) == rows(served.rows.filter(f"razao_social ILIKE '%{text}%' OR nome_fantasia ILIKE '%{text}%'"))
