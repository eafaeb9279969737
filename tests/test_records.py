"""Records of files whose quoted fields span lines, read in ranges, against a plain state machine."""

import random

import pytest

from rollbook.sources import raw_files as R
from rollbook.sources import records as Q
from rollbook.sources.registry import LOOKUP, Layout

TABLE = Layout("things", ("a", "b", "c"), ("things",), LOOKUP, ("a",))


@pytest.fixture
def small_ranges(spark):
    """Files are cut every few bytes, or every few hundred."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def brute(text, sep=";"):
    """[(record, line, fields)] of the records that are not blank lines."""
    out, fields, field, state, record, line, first = [], [], "", "start", 1, 1, 1
    k = 0

    def end():
        nonlocal fields, field, state, record, first
        if state == "plain" or state == "start":
            field = field[:-1] if field.endswith("\r") else field
        whole = fields + [field]
        if not (len(whole) == 1 and state != "closed" and not field.strip("".join(map(chr, range(33))))):
            out.append((record, first, whole))
        fields, field, state = [], "", "start"
        record += 1

    while k < len(text):
        c = text[k]
        if state == "quoted":
            if c == '"':
                if text[k + 1 : k + 2] == '"':
                    field += '"'
                    k += 1
                else:
                    state = "closed"
            else:
                field += c
        elif c == "\n":
            end()
            first = line + 1
        elif c == sep:
            fields, field, state = [*fields, field], "", "start"
        elif c == '"' and state == "start":
            state = "quoted"
        elif not (state == "closed" and c == "\r"):
            field, state = field + c, "plain" if state == "start" else state
        line += c == "\n"
        k += 1
    if text and not text.endswith("\n"):
        end()
    return out


def read(spark, path, spans=True):
    rows = R.numbered_rows(spark, [path], TABLE, spans).collect()
    return sorted((r["record"], r["line"], r["a"] or "", r["b"] or "", r["c"] or "") for r in rows)


def wanted(text):
    return sorted((n, line, *(f + ["", "", ""])[:3]) for n, line, f in brute(text))


@pytest.mark.parametrize("size", [40, 300, 1 << 20])
def test_ranges_give_the_same_records(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    rng = random.Random(size)
    text = ""
    for _ in range(120):
        text += ";".join(rng.choice(["x", "", "ab", '"q"', '"l\nm"', '"a;b\n;"', '"say ""hi""\n\n"', '"c\r\nd"', 'tube 5"', "é"]) for _ in range(rng.randrange(1, 5))) + rng.choice(["\n", "\r\n", "\n\n", "\n \n"])
    (tmp_path / "things").write_bytes(text.encode("latin-1"))
    assert read(spark, str(tmp_path / "things")) == wanted(text)
    ranges = Q.file_ranges(Q.raw_lines(spark, [str(tmp_path)]))
    if size == 40:
        assert ranges.count() > 20 and ranges.filter("begin = 1").count() > 0
    found = ranges.agg({"blank_lines": "sum", "records": "sum"}).first()
    assert found["sum(records)"] - found["sum(blank_lines)"] == len(brute(text))


def test_one_odd_quote_does_not_make_one_task(spark, tmp_path, small_ranges):
    small_ranges(6000)
    text = "".join(f'"{k}";"name {k}";x\n' for k in range(3000)) + '9;5" tube;y\n' + '7;"two\nlines";z\n' + "".join(f"{k};n;x\n" for k in range(2000))
    (tmp_path / "things").write_bytes(text.encode())
    frame = R.scan_raw(spark, [str(tmp_path / "things")], TABLE)
    assert Q.raw_lines(spark, [str(tmp_path / "things")]).rdd.getNumPartitions() > 10
    rows = {(r["a"], r["b"]) for r in frame.collect()}
    assert len(rows) == 5002 and {("9", '5" tube'), ("7", "two\nlines")} <= rows


def test_several_files_and_lines_without_quotes(spark, tmp_path, small_ranges):
    small_ranges(50)
    for name in ("u", "v"):
        (tmp_path / name).write_text("\n".join(f"{name}{k};b\n" if k % 10 == 0 else f"{name}{k};b" for k in range(100)))
    rows = R.numbered_rows(spark, [str(tmp_path / "u"), str(tmp_path / "v")], TABLE, spans=False).collect()
    again = R.numbered_rows(spark, [str(tmp_path)], TABLE).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == 200
    for r in rows:
        k = int(r["a"][1:])
        assert r["record"] == r["line"] == k + 1 + (k + 9) // 10 and r["source_path"].endswith(r["a"][0])


def test_a_quote_that_never_closes_is_an_error(spark, tmp_path, small_ranges, monkeypatch):
    small_ranges(100)
    monkeypatch.setattr(Q, "MAX_LINES", 150)
    (tmp_path / "things").write_text("1;2\n" + '3;"open\n' + "4;5\n" * 200)
    with pytest.raises(Q.UnclosedQuote, match="things: record 2 has 1"):
        R.numbered_rows(spark, [str(tmp_path / "things")], TABLE)


def test_empty_files(spark, tmp_path):
    (tmp_path / "things").write_text("")
    assert R.numbered_rows(spark, [str(tmp_path)], TABLE).count() == 0


def test_headered_in_ranges(spark, tmp_path, small_ranges):
    small_ranges(40)
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text('"co ""x""",text\n' + "".join(f'{name}{k},"line é\nnext, {k}"\n' for k in range(30)), encoding="utf-8")
    rows = R.scan_headered(spark, str(tmp_path)).collect()
    assert {(r['co "x"'], r["text"]) for r in rows} == {(f"{n}{k}", f"line é\nnext, {k}") for n in ("a.csv", "b.csv") for k in range(30)}


def test_lines_are_not_sorted_and_only_records_over_an_end_meet(spark, tmp_path, small_ranges):
    small_ranges(60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        text = "".join(f'{k};"one\n\n{k}";x\n' + "\n" * (k % 3 == 0) for k in range(60)) + "k;" + '"a\nb";' * 20 + "\n9;z;"
        (tmp_path / "things").write_text(text)
        rows = R.numbered_rows(spark, [str(tmp_path / "things")], TABLE)
        assert read(spark, str(tmp_path / "things")) == wanted(text)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Sort" not in plan and plan.count("Aggregate") == 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
