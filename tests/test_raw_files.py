import pytest

from rollbook.operators import cleaning as C
from rollbook.sources import raw_files as R
from rollbook.sources.registry import EMPRESAS, LAYOUTS

DIRTY = (
    "11111111;AURORA PAES LTDA;2062;49;100000,00;03;\n"
    ";;;;;;\n"
    "\n"
    ";NAME WITHOUT KEY;2062;49;1,00;03;\n"
    "00000000;X;2062;49;1,00;03;\n"
    "44444444;  PADDED \t;2062;49;1,00;03;\n"
    "55555555;NA;N/A;49;0001-01-01;000;na\n"
    '66666666;"SAY ""HI""; LTDA";2062;49;1,00;03;\n'
    "88888888;SHORT\n"
    "99999999;A;B;C;D;E;F;EXTRA\n"
    "12121212;SÃO JOSÉ;2062;49;1,00;03;\n"
)
TWO_LINES = '77777777;"TWO\nLINES";2062;49;1,00;03;\n'


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "K3241.K03200Y0.D51213.EMPRECSV").write_bytes(DIRTY.encode("latin-1"))
    (tmp_path / "K3241.K03200Y1.D51213.EMPRECSV").write_bytes(TWO_LINES.encode("latin-1"))
    (tmp_path / "K3241.EMPRECSV.tmp").write_bytes(b"99;unfinished")
    return str(tmp_path)


def sources(spark, drop):
    return [r["path"] for r in R.match_sources(R.list_files(spark, drop)).filter("table = 'empresas'").collect()]


EXPECTED = {
    "11111111": ("AURORA PAES LTDA", "2062", "49", "100000,00", "03", None),
    "44444444": ("PADDED", "2062", "49", "1,00", "03", None),
    "55555555": (None, None, "49", None, None, "na"),
    "66666666": ('SAY "HI"; LTDA', "2062", "49", "1,00", "03", None),
    "77777777": ("TWO\nLINES", "2062", "49", "1,00", "03", None),
    "88888888": ("SHORT", None, None, None, None, None),
    "99999999": ("A", "B", "C", "D", "E", "F"),
    "12121212": ("SÃO JOSÉ", "2062", "49", "1,00", "03", None),
}


@pytest.mark.parametrize("multi_line", [None, True])
def test_dirty_rows(spark, drop, multi_line):
    raw = R.scan_raw(spark, sources(spark, drop), EMPRESAS, multi_line)
    got = {r[0]: tuple(r)[1:] for r in C.clean_table(raw, EMPRESAS).collect()}
    assert got == EXPECTED


def test_exempt_key_keeps_all_zero_company(spark, drop):
    raw = R.scan_raw(spark, sources(spark, drop), EMPRESAS)
    kept = C.clean_table(raw, EMPRESAS, ["cnpj_basico"])
    assert kept.filter("cnpj_basico = '00000000'").count() == 1


def test_counters(spark, drop):
    raw = R.scan_raw(spark, sources(spark, drop), EMPRESAS)
    m = C.clean_metrics(C.classify_rows(C.clean_cells(raw), EMPRESAS.columns, EMPRESAS.required)).first()
    assert (m["rows"], m["skipped_empty"], m["skipped_invalid_required"]) == (8, 1, 2)


def test_profile_finds_quoted_line_breaks_and_blank_lines(spark, drop):
    profile = {r["path"].rsplit("/", 1)[-1]: r for r in R.raw_profile(spark, sources(spark, drop)).collect()}
    assert profile["K3241.K03200Y0.D51213.EMPRECSV"]["blank_lines"] == 1
    assert profile["K3241.K03200Y0.D51213.EMPRECSV"]["odd_quote_lines"] == 0
    by_reader = R.files_by_reader(R.raw_profile(spark, sources(spark, drop)))
    assert [p.rsplit(".", 2)[-2:] for p in by_reader[True]] == [["D51213", "EMPRECSV"]] and len(by_reader[False]) == 1
    assert "K03200Y1" in by_reader[True][0]


def test_folders_and_files_of_one_name(spark, tmp_path):
    """Line breaks survive a scan by folder, and a name shared with a plain file decides nothing."""
    for folder, text in (("a b", '1;"a\nb"\n2;c\n'), ("c", '3;5" tube\n'), ("d", "4;plain\n"), ("e", "")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "EMPRECSV").write_text(text, encoding="latin-1")
    folders = [str(tmp_path / f) for f in ("a b", "c", "d", "e")]
    got = {(r[0], r[1]) for r in R.scan_raw(spark, folders, EMPRESAS).collect()}
    assert got == {("1", "a\nb"), ("2", "c"), ("3", '5" tube'), ("4", "plain")}
    assert R.scan_raw(spark, [folders[3]], EMPRESAS).count() == 0


def test_source_path(spark, drop):
    raw = R.scan_raw(spark, sources(spark, drop), EMPRESAS, with_source=True)
    bad = C.blank_key_samples(raw, "cnpj_basico", ["razao_social"])
    assert all(r["source_path"].endswith("EMPRECSV") for r in bad.collect())
    assert C.blank_key_count(raw, "cnpj_basico").first()["bad_rows"] == 2


# Inner file names as published.
NAMES = {
    "K3241.K03200Y0.D51213.EMPRECSV": "empresas",
    "K3241.K03200Y0.D51213.ESTABELE": "estabelecimentos",
    "K3241.K03200Y0.D51213.SOCIOCSV": "socios",
    "F.K03200$W.SIMPLES.CSV.D51213": "simples",
    "F.K03200$Z.D51213.CNAECSV": "cnaes",
    "F.K03200$Z.D51213.MUNICCSV": "municipios",
    "F.K03200$Z.D51213.NATJUCSV": "naturezas",
    "F.K03200$Z.D51213.QUALSCSV": "qualificacoes",
    "F.K03200$Z.D51213.MOTICSV": "motivos",
    "F.K03200$Z.D51213.PAISCSV": "paises",
}


def test_published_names_match_their_tables(spark):
    files = spark.createDataFrame([(n, 1) for n in [*NAMES, "PORTECSV.tmp", "readme.txt"]], "name string, length long")
    got = {(r["name"], r["table"]) for r in R.match_sources(files).collect()}
    assert got == set(NAMES.items())


def test_special_characters_in_file_names(spark, tmp_path):
    (tmp_path / "F.K03200$W.SIMPLES.CSV.D51213").write_text('11111111;N;"a\nb";x\n', encoding="latin-1")
    path = [r["path"] for r in R.list_files(spark, str(tmp_path)).collect()]
    got = R.scan_raw(spark, path, LAYOUTS["simples"]).collect()
    assert [r["data_opcao_simples"] for r in got] == ["a\nb"]


def test_headered_columns_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text('descricao,codigo\n"A, ""B""\nC",01\n,02\n', encoding="utf-8")
    got = {r["codigo"]: r["descricao"] for r in R.scan_headered(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {"01": 'A, "B"\nC', "02": None}
