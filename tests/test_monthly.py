"""The registry fixture from raw files to answers."""

import zipfile

import pytest

from rollbook.operators import checks, drops, ledger as L, search as S
from rollbook.plans import monthly
from rollbook.sources import archives, listings, raw_files
from rollbook.sources.registry import LAYOUTS
from rollbook.sources.run_events import RunEvents
from rollbook.sources.tables import TableFolder
from rollbook.streaming.drops import watch_drops
from tests.helpers import rows

def branch(base, dv, cnae, uf, town):
    return (
        f"{base};0001;{dv};1;LOJA {dv};02;20210704;00;;;20170312;{cnae};;TRAVESSA;DO CAIS;{dv};;PORTO;88000{dv}0;{uf};{town};47;"
        f"5550{dv};;;;;loja{dv}@exemplo.net;;\n"
    )


RAW = {
    "K3241.K03200Y0.D51213.EMPRECSV": """
40000001;AURORA PAES LTDA;9001;61;7500,50;03;
40000002;ESTALEIRO AURORA SA;9002;62;900000,00;05;
40000003;OFICINA DO VALE;9003;63;1200,00;01;
""",
    "K3241.K03200Y0.D51213.ESTABELE": (
        branch("40000001", 17, "5000001", "SC", "0301") + branch("40000002", 28, "5000001", "SC", "0301")
        + branch("40000003", 39, "5000002", "BA", "0402")
    ),
    "K3241.K03200Y0.D51213.SOCIOCSV": """
40000001;2;INES PADEIRA;11100011100;61;20170312;;;;;5
40000002;2;RUI ARMADOR;22200022200;62;20160229;;;;;6
""",
    "F.K03200$W.SIMPLES.CSV.D51213": """
40000001;N;00000000;00000000;N;00000000;00000000
40000002;S;20180630;00000000;N;00000000;00000000
40000003;N;00000000;00000000;N;00000000;00000000
""",
    "F.K03200$Z.D51213.CNAECSV": "\n5000001;PAES E BARCOS\n5000002;CONSERTO DE MAQUINAS\n",
    "F.K03200$Z.D51213.MUNICCSV": "\n0301;PORTO NOVO\n0402;VALE FUNDO\n",
    "F.K03200$Z.D51213.NATJUCSV": "\n9001;LIMITADA\n9002;ANONIMA\n9003;INDIVIDUAL\n",
    "F.K03200$Z.D51213.QUALSCSV": "\n61;SOCIA\n62;GERENTE\n63;DONO\n",
    "F.K03200$Z.D51213.MOTICSV": "\n00;NENHUM\n",
    "F.K03200$Z.D51213.PAISCSV": "\n105;BRASIL\n",
}
ARCHIVES = {
    "EMPRECSV": "Empresas0.zip", "ESTABELE": "Estabelecimentos0.zip", "SOCIOCSV": "Socios0.zip",
    "SIMPLES": "Simples.zip", "CNAECSV": "Cnaes.zip", "MUNICCSV": "Municipios.zip", "NATJUCSV": "Naturezas.zip",
    "QUALSCSV": "Qualificacoes.zip", "MOTICSV": "Motivos.zip", "PAISCSV": "Paises.zip",
}


def write_raw(folder, changes=None):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in {**RAW, **(changes or {})}.items():
        if text is not None:
            (folder / name).write_bytes(text.lstrip("\n").encode("latin-1"))
    return str(folder)


def options(run_key="2026-03", **kwargs):
    return monthly.Options(run_key, f"{run_key}-01 00:00:00", **kwargs)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("registry")
    zips = base / "zips"
    zips.mkdir()
    for name, text in RAW.items():
        alias = next(a for a in ARCHIVES if a in name)
        with zipfile.ZipFile(zips / ARCHIVES[alias], "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("folder/", "")
            z.writestr(f"folder/{name}", text.lstrip("\n").encode("latin-1"))
    (zips / "Notes.zip").write_bytes(b"not wanted")
    root = str(base / "root")
    monthly.run_load(spark, root, str(base / "raw"), options(), archive_folder=str(zips))
    return TableFolder(spark, root)


def test_row_counts(loaded):
    counts = {n: monthly.current_rows(loaded, LAYOUTS[n]).count() for n in ("empresas", "estabelecimentos", "socios", "simples")}
    assert counts == {"empresas": 3, "estabelecimentos": 3, "socios": 2, "simples": 3}
    assert monthly.serving_rows(loaded).count() == 3
    assert monthly.current_rows(loaded, LAYOUTS["portes"]) is None


def test_values(loaded):
    view = monthly.serving_rows(loaded)
    row = S.lookup_one(view, "40000001000117")
    assert (row["uf"], row["municipio_descricao"], row["razao_social"]) == ("SC", "PORTO NOVO", "AURORA PAES LTDA")
    assert row["cnae_fiscal_descricao"] and row["porte_descricao"] is None and row["capital_social"] == "7500,50"
    assert row["data_opcao_simples"] is None and row["run_key"] == "2026-03"
    assert S.lookup_one(view, "40000002")["opcao_pelo_simples"] == "S"
    assert view.filter("data_exclusao_simples is not null or porte_descricao is not null").isEmpty()


def test_searches(loaded):
    view = monthly.serving_rows(loaded)
    assert S.search(view, razao_social="aurora").count() == 2
    assert S.search(view, uf="sc").count() == 2
    assert S.search(view, uf="BA").count() == 1
    assert S.search(view, cnae="5000001").count() == 2
    assert S.search(view, municipio="vale", situacao="02").count() == 1


def test_health_and_steps(spark, loaded):
    events = RunEvents(spark, f"{loaded.root}/run_events").read()
    runs = L.run_records(L.whole_runs(events))
    row = L.health(runs, monthly.serving_rows(loaded)).first()
    assert tuple(row) == ("ok", "2026-03", 3)
    steps = [r["step_name"] for r in L.job_steps(L.step_rollup(events), "load-2026-03").collect()]
    assert steps == ["run", "verify", "extract", "transform", "load", "serve"]
    summary = spark.read.json(f"{loaded.root}/metrics/status/run_key=2026-03").orderBy("position").collect()
    assert [(r["run_key"], r["status"]) for r in summary] == [("2026-03", "SUCCESS")] * 2


def test_second_run_is_skipped(spark, loaded):
    before = loaded.current_versions()
    monthly.run_load(spark, loaded.root, "/nowhere", options(), archive_folder="/nowhere")
    assert loaded.current_versions() == before


def test_steps_resume_die_and_start_over(spark, tmp_path):
    events, seen = RunEvents(spark, str(tmp_path / "events")), []

    def fail():
        raise RuntimeError("boom")

    def run(second, force=False):
        monthly.run_steps(events, "j", "2026-03", [("a", lambda: seen.append("a")), ("b", second)], force)

    for expected in ("FAILED", "FAILED", "DEAD"):
        with pytest.raises(monthly.LoadFailed, match="b: boom"):
            run(fail)
        last = L.run_records(L.whole_runs(events.read())).first()
        assert (last["status"], last["last_error"]) == (expected, "b: boom")
    assert seen == ["a"]
    with pytest.raises(monthly.LoadFailed, match="no attempt left"):
        run(lambda: seen.append("b"))
    assert seen == ["a"]
    events.append("j", "2026-03", L.WHOLE_RUN, "PENDING")
    run(lambda: seen.append("b"))
    run(fail)
    assert seen == ["a", "a", "b"]
    run(lambda: seen.append("b"), force=True)
    assert seen == ["a", "a", "b", "a", "b"]
    events.append("j", "2026-03", L.WHOLE_RUN, "PENDING")
    run(lambda: None)
    assert seen == ["a", "a", "b", "a", "b", "a"]


def test_errors_are_recorded_whole(spark, tmp_path):
    events = RunEvents(spark, str(tmp_path / "events"))

    def fail():
        raise RuntimeError("x" * 5000)

    with pytest.raises(monthly.LoadFailed):
        monthly.run_steps(events, "j", "2026-03", [("a", fail)])
    assert L.run_records(L.whole_runs(events.read())).first()["last_error"] == "a: " + "x" * 5000


def test_a_load_takes_all_archives(spark, tmp_path):
    with pytest.raises(ValueError, match="dry runs"):
        monthly.run_load(spark, str(tmp_path / "root"), str(tmp_path / "raw"), options(), archive_folder=str(tmp_path), max_files=3)
    names = spark.createDataFrame([("Empresas0.zip",), ("Socios0.zip",)], "name string")
    monthly.require_found(names, names)
    with pytest.raises(checks.CheckFailed, match="missing archives: 1, the first Socios0.zip"):
        monthly.require_found(names, names.filter("name = 'Empresas0.zip'"))


def test_serving_needs_the_base_tables(spark, tmp_path):
    with pytest.raises(checks.CheckFailed, match="empresas, estabelecimentos"):
        monthly.refresh_serving(TableFolder(spark, str(tmp_path / "root")), options())


def test_next_month(spark, tmp_path):
    """Change, removal, arrival; the company's stamps move, the branch's own do not reach the view."""
    root = str(tmp_path / "root")
    folder = TableFolder(spark, root)
    monthly.run_load(spark, root, write_raw(tmp_path / "a"), options("2026-02"))
    changed = {
        "K3241.K03200Y0.D51213.EMPRECSV": "40000001;AURORA DOCES LTDA;9001;61;7500,50;03;\n"
        "40000002;ESTALEIRO AURORA SA;9002;62;900000,00;05;\n40000004;NOVA;9002;62;1,00;05;\n;SEM CHAVE;;;;;\n;;;;;;\n",
        "F.K03200$Z.D51213.MOTICSV": None,
    }
    monthly.run_load(spark, root, write_raw(tmp_path / "b", changed), options("2026-03"))
    got = {
        r["cnpj_basico"]: (r["razao_social"], r["run_key"], r["created_at"].month, r["updated_at"].month)
        for r in monthly.current_rows(folder, LAYOUTS["empresas"]).collect()
    }
    assert got == {
        "40000001": ("AURORA DOCES LTDA", "2026-03", 2, 3),
        "40000002": ("ESTALEIRO AURORA SA", "2026-02", 2, 2),
        "40000004": ("NOVA", "2026-03", 3, 3),
    }
    load = {r["table"]: (r["inserted"], r["updated"], r["deleted"]) for r in spark.read.json(f"{root}/metrics/load/run_key=2026-03").collect()}
    assert load["empresas"] == (1, 1, 1) and load["estabelecimentos"] == (0, 0, 0) and "motivos" not in load
    clean = {r["table"]: r for r in spark.read.json(f"{root}/metrics/transform/run_key=2026-03").collect()}
    assert (clean["empresas"]["rows"], clean["empresas"]["skipped_empty"], clean["empresas"]["skipped_invalid_required"]) == (3, 1, 1)
    assert clean["motivos"]["note"] == "no file"
    # No file this month: the code table stays as it was.
    assert monthly.current_rows(folder, LAYOUTS["motivos"]).count() == 1
    view = {r["cnpj_basico"]: r["run_key"] for r in monthly.serving_rows(folder).collect()}
    assert view == {"40000001": "2026-03", "40000002": "2026-02"}

    # A drop that is too small stops the table, but not the others, and the run resumes at that step.
    small = {"K3241.K03200Y0.D51213.EMPRECSV": "40000001;X;2062;49;1,00;03;\n"}
    raw = write_raw(tmp_path / "c", small)
    with pytest.raises(monthly.LoadFailed, match="nothing was changed"):
        monthly.run_load(spark, root, raw, options("2026-04"))
    assert monthly.current_rows(folder, LAYOUTS["empresas"]).count() == 3
    runs = L.run_records(L.whole_runs(RunEvents(spark, f"{root}/run_events").read()))
    assert rows(runs.filter("run_key = '2026-04'"), "status", "attempts") == {("FAILED", 1)}
    monthly.run_load(spark, root, raw, options("2026-04", min_ratio=0.1))
    assert monthly.current_rows(folder, LAYOUTS["empresas"]).count() == 1
    steps = L.step_rollup(RunEvents(spark, f"{root}/run_events").read()).filter("job_id = 'load-2026-04'")
    assert rows(steps, "step_name", "runs") == {("run", 2), ("transform", 1), ("load", 2), ("serve", 1)}


def test_duplicates_and_long_values_stop_the_load(spark, tmp_path):
    twice = {"K3241.K03200Y0.D51213.EMPRECSV": "40000001;B;;;;;\n40000001;A;;;;;\n"}
    raw = write_raw(tmp_path / "raw", twice)
    with pytest.raises(monthly.LoadFailed, match="duplicate key"):
        monthly.run_load(spark, str(tmp_path / "r1"), raw, options())
    monthly.run_load(spark, str(tmp_path / "r2"), raw, options(on_duplicate="first"))
    companies = monthly.current_rows(TableFolder(spark, str(tmp_path / "r2")), LAYOUTS["empresas"])
    assert rows(companies, "razao_social") == {("A",)}
    long = {"K3241.K03200Y0.D51213.EMPRECSV": "40000001;A;20621;;;;\n"}
    with pytest.raises(monthly.LoadFailed, match="too long"):
        monthly.run_load(spark, str(tmp_path / "r3"), write_raw(tmp_path / "raw3", long), options())


def test_dry_run_stops_after_cleaning(spark, loaded, tmp_path):
    zips = str(loaded.root).replace("/root", "/zips")
    root = str(tmp_path / "root")
    monthly.run_load(spark, root, str(tmp_path / "raw"), options(), archive_folder=zips, max_files=3, dry_run=True)
    assert raw_files.list_files(spark, str(tmp_path / "raw")).count() == 3
    assert TableFolder(spark, root).current_versions() == {}


def test_unknown_table_is_skipped(spark, loaded):
    assert monthly.load(spark, loaded, options(), ["nonsense"]).count() == 0


def test_damaged_archives(spark, tmp_path):
    good, bad = tmp_path / "Cnaes.zip", tmp_path / "Paises.zip"
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("a.CNAECSV", "1;x\n")
    data = bytearray(good.read_bytes())
    data[data.index(b"1;x")] = ord("9")
    bad.write_bytes(bytes(data))
    (tmp_path / "Motivos.zip").write_bytes(b"")
    (tmp_path / "Portes.zip").write_bytes(b"no archive")
    names = [(n,) for n in ("Cnaes.zip", "Paises.zip", "Motivos.zip", "Portes.zip", "Simples.zip")]
    expected = spark.createDataFrame(names, "name string")
    report = monthly.verify_archives(spark, str(tmp_path), expected)
    got = {r["name"]: (r["ok"], (r["error"] or "").split(":")[0], len(r["sha256"] or "")) for r in report.collect()}
    assert got == {
        "Cnaes.zip": (True, "", 64), "Paises.zip": (False, "damaged member", 0), "Motivos.zip": (False, "no bytes", 0),
        "Portes.zip": (False, "not readable", 0), "Simples.zip": (False, "absent", 0),
    }
    with pytest.raises(checks.CheckFailed, match="damaged archives: 4, the first Motivos.zip: no bytes"):
        monthly.require_sound(report)


def test_extract_keeps_first_of_equal_names_and_existing_files(spark, tmp_path):
    zips, target = tmp_path / "z", tmp_path / "out"
    zips.mkdir(), target.mkdir()
    for archive, member, text in (("a.zip", "x/data.csv", "first"), ("b.zip", "y/data.csv", "second"), ("b.zip", "keep.csv", "new")):
        with zipfile.ZipFile(zips / archive, "a") as z:
            z.writestr(member, text)
    (target / "keep.csv").write_text("old")
    for _ in range(2):
        done = archives.extract_files(raw_files.list_files(spark, str(zips)), str(target))
        assert rows(done, "name", "bytes") == {("data.csv", 5), ("keep.csv", 3)}
    assert (target / "data.csv").read_text() == "first" and (target / "keep.csv").read_text() == "old"
    assert sorted(p.name for p in target.iterdir() if not p.name.startswith(".")) == ["data.csv", "keep.csv"]


def test_a_cut_file_is_extracted_again(spark, tmp_path):
    zips, target = tmp_path / "z", tmp_path / "out"
    zips.mkdir(), target.mkdir()
    with zipfile.ZipFile(zips / "a.zip", "w") as z:
        z.writestr("data.csv", "whole")
    (target / "data.csv").write_text("who")
    assert rows(archives.extract_files(raw_files.list_files(spark, str(zips)), str(target)), "bytes") == {(5,)}
    assert (target / "data.csv").read_text() == "whole"


def test_watch_drops_handles_each_note_once(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    seen = []
    for i, key in enumerate(("2026-01", "2026-02", "2026-03")):
        (notes / f"{key}.json").write_text(f'{{"run_key": "{key}", "folder": "f{i}"}}\n')
        watch_drops(spark, str(notes), str(tmp_path / "cp"), lambda k, f: seen.append((k, f))).awaitTermination()
    assert seen == [("2026-01", "f0"), ("2026-02", "f1"), ("2026-03", "f2")]


def test_failed_load_reports_what_it_published(spark, tmp_path):
    root = str(tmp_path / "root")
    twice = {"K3241.K03200Y0.D51213.EMPRECSV": "40000001;B;;;;;\n40000001;A;;;;;\n"}
    with pytest.raises(monthly.LoadFailed):
        monthly.run_load(spark, root, write_raw(tmp_path / "raw", twice), options())
    done = {r["table"]: r["inserted"] for r in spark.read.json(f"{root}/metrics/load_partial/run_key=2026-03").collect()}
    assert "empresas" not in done and done["estabelecimentos"] > 0


def _zip_drop(folder, name):
    folder.mkdir(exist_ok=True)
    for archive, member, text in (
        ("Empresas0.zip", "K.EMPRECSV", f"40000001;{name};2062;49;1,00;03;\n"),
        ("Estabelecimentos0.zip", "K.ESTABELE", "40000001;0001;91;1;X" + ";" * 25 + "\n"),
    ):
        with zipfile.ZipFile(folder / archive, "w") as z:
            z.writestr(member, text)


def _listed(spark, tag, sizes=None):
    files = [("2026-05.txt", "-"), ("Empresas0.zip", tag), ("Estabelecimentos0.zip", "1")]
    return spark.createDataFrame(
        [(n, n, False, (sizes or {}).get(n, 0), "", t) for n, t in files], "name string, path string, is_dir boolean, size long, modified string, etag string"
    )


def test_drop_from_listing_to_load(spark, tmp_path):
    """Only a look, a load, nothing new, a republished drop that is forced, a missing archive."""
    root, raw, zips = str(tmp_path / "root"), str(tmp_path / "raw"), tmp_path / "zips"
    _zip_drop(zips, "ONE")

    def drop(tag, **more):
        got = monthly.run_drop(spark, root, raw, str(zips), _listed(spark, tag), **more)
        return got["run_key"], got["files"], got["decision"], got["job_id"]

    def names():
        return rows(monthly.serving_rows(TableFolder(spark, root)), "razao_social")

    assert drop("1", check_only=True) == ("2026-05", 2, "load", None) and not (tmp_path / "root").exists()
    assert drop("1") == ("2026-05", 2, "load", "load-2026-05") and names() == {("ONE",)}
    assert drop("1")[2:] == ("done", None) and drop("2")[2:] == ("done", None)
    _zip_drop(zips, "TWO")
    assert drop("2", force=True)[2:] == ("load", "load-2026-05") and names() == {("TWO",)}
    (zips / "Empresas0.zip").unlink()
    with pytest.raises(monthly.LoadFailed, match="missing archives: 1, the first Empresas0.zip"):
        drop("3", run_key="2026-06")
    assert drop("3", run_key="2026-06", check_only=True)[2] == "resume"
    _zip_drop(zips, "THREE")
    assert drop("3", run_key="2026-06")[2:] == ("resume", "load-2026-06") and names() == {("THREE",)}
    with pytest.raises(monthly.LoadFailed, match="no wanted archive"):
        monthly.run_drop(spark, root, raw, str(zips), _listed(spark, "1").filter("etag = '-'"))


def test_a_run_that_died_after_its_listing_was_saved_is_loaded(spark, tmp_path):
    root, raw, zips = str(tmp_path / "root"), str(tmp_path / "raw"), tmp_path / "zips"
    _zip_drop(zips, "ONE")
    listing = _listed(spark, "1")
    wanted = drops.wanted_files(listing)
    listings.write_manifest(wanted, "2026-05", f"{root}/manifests/run_key=2026-05")
    got = monthly.run_drop(spark, root, raw, str(zips), listing)
    assert (got["decision"], got["job_id"]) == ("load", "load-2026-05")


def test_an_archive_of_another_size_than_listed_stops_the_load(spark, tmp_path):
    root, raw, zips = str(tmp_path / "root"), str(tmp_path / "raw"), tmp_path / "zips"
    _zip_drop(zips, "ONE")
    sizes = {p.name: p.stat().st_size for p in zips.iterdir()}
    wrong = {**sizes, "Empresas0.zip": sizes["Empresas0.zip"] + 1}
    with pytest.raises(monthly.LoadFailed, match="another size than listed: 1, the first Empresas0.zip"):
        monthly.run_drop(spark, root, raw, str(zips), _listed(spark, "1", wrong), check_only=False)
    assert monthly.run_drop(spark, root, raw, str(zips), _listed(spark, "2", sizes), check_only=True)["decision"] == "load"
