import io
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from rollbook.functions.status import final_status
from rollbook.operators import drops as D, ledger as L
from rollbook.sources import archives, listings
from rollbook.sources.run_events import RunEvents
from rollbook.sources.tables import TableFolder, replace_partitions
from rollbook.streaming.status import keep_latest, latest_rows, live_rollup
from tests.helpers import rows


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_archives_held_as_bytes_are_read_to_their_end(spark):
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w") as archive:
        archive.writestr("a.csv", b"some text that is long enough")
    good = whole.getvalue()
    held = [("good", good), ("cut", good[:-30]), ("changed", good.replace(b"long", b"LONG")), ("empty", b"")]
    got = archives.read_contents(spark.createDataFrame(held, "path string, content binary"))
    assert {r["path"]: (r["problem"], r["detail"]) for r in got.collect() if r["path"] != "cut"} == {
        "good": (None, None), "changed": ("damaged member", "a.csv"), "empty": ("no bytes", None),
    }
    assert got.filter("path = 'cut'").first()["problem"] == "not readable"


def test_months_and_folders(spark):
    files = names(spark, ["Empresas_2026-01.zip", "x202602.zip", "2025_12", "none.zip"])
    assert rows(D.months(files)) == {("2026-01",), ("2026-02",), ("2025-12",)}
    assert rows(D.latest_month(files)) == {("2026-02",)}
    assert D.latest_month(names(spark, ["none"])).first()[0] == datetime.now(timezone.utc).strftime("%Y-%m")
    assert rows(D.latest_month_folder(names(spark, ["2025-12", "2026-01x", "temp"]))) == {("2025-12",)}
    assert rows(D.latest_month_folder(names(spark, ["temp"]))) == {(None,)}


def test_wanted(spark):
    data = [("Empresas0.ZIP", False), ("empresas1.zip", True), ("old_socios.zip", False), ("Socios.csv", False), ("x.zip", False)]
    files = spark.createDataFrame(data, "name string, is_dir boolean")
    assert rows(D.wanted_files(files), "name") == {("Empresas0.ZIP",), ("old_socios.zip",)}
    assert rows(D.wanted_files(files, match="prefix"), "name") == {("Empresas0.ZIP",)}
    assert rows(D.wanted_files(files, ["x"]), "name") == {("x.zip",)}


def test_smallest(spark):
    files = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "name string, size long")
    assert [r["name"] for r in D.smallest_files(files, 2).collect()] == ["c", "a"]
    assert D.smallest_files(files, 0).count() == 1


def test_manifest_diff(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], "name string, etag string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1"), ("c", None)], "name string, etag string")
    assert rows(D.manifest_diff(old, new), "name", "change") == {("b", "changed"), ("d", "added")}
    assert D.files_changed(old, new) and not D.files_changed(old, old) and D.files_changed(None, new)
    assert rows(D.manifest_diff(new, old), "name", "change") == {("b", "changed"), ("d", "removed")}


LISTING = """<?xml version="1.0"?>
<d:multistatus xmlns:d="DAV:">
 <d:response><d:href>/public.php/webdav/</d:href><d:propstat><d:prop><d:getetag>"r"</d:getetag></d:prop></d:propstat></d:response>
 <d:response><d:href>/public.php/webdav/2026-03/</d:href><d:propstat><d:prop><d:getetag>"d"</d:getetag></d:prop></d:propstat></d:response>
 <d:response><d:href>/public.php/webdav/2026-03/S%C3%A3o%20a+b.zip</d:href>
  <d:propstat><d:prop><d:getcontentlength>42</d:getcontentlength><d:getlastmodified>Sun</d:getlastmodified><d:getetag>"e"</d:getetag></d:prop></d:propstat>
  <d:propstat><d:prop><d:getetag>"second"</d:getetag></d:prop></d:propstat></d:response>
 <d:response><d:href>/other/x.zip</d:href><d:propstat><d:prop><d:getetag>"o"</d:getetag></d:prop></d:propstat></d:response>
 <d:response><d:href>/public.php/webdav/none.zip</d:href></d:response>
</d:multistatus>
"""


def test_listing(spark, tmp_path):
    (tmp_path / "l.xml").write_text(LISTING, encoding="utf-8")
    assert rows(listings.read_listing(spark, str(tmp_path / "l.xml"))) == {
        ("2026-03", "2026-03", True, 0, "", "d"),
        ("São a+b.zip", "2026-03/S%C3%A3o%20a+b.zip", False, 42, "Sun", "e"),
    }
    xml = spark.createDataFrame([(LISTING,)], "x string")
    assert len(xml.select(listings.listing_hrefs(F.col("x"))).first()[0]) == 4


def test_manifest_document(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"run_key": "2026-03",\n "files": [{"name": "a.zip", "etag": "1", "size": 5},\n {"name": "b.zip"}]}'
    )
    got = listings.read_manifest(spark, str(tmp_path / "m.json"))
    assert rows(got, "run_key", "name", "etag", "size") == {("2026-03", "a.zip", "1", 5), ("2026-03", "b.zip", None, None)}


def test_links(spark):
    html = (
        "<!-- <a href='/no'>--><script>var a='<a href=\"/no2\">'</script><A class=x HREF='d/E.ZIP'>x</a><a>y</a>"
        '<a data-href="/no3" title="t" href="?a=1&amp;b=2">z</a><abbr href="/no4">'
    )
    page = spark.createDataFrame([(1, "http://h.example.com/p/q", html)], "page_id int, url string, html string")
    links = listings.page_links(page)
    assert [(r["position"], r["link"]) for r in links.orderBy("position").collect()] == [
        (0, "http://h.example.com/p/d/E.ZIP"), (1, "http://h.example.com/p/q?a=1&b=2"),
    ]
    assert listings.archive_links(links).count() == 1


def test_links_without_quotes_and_with_entities(spark):
    html = (
        "<a href=plain/x.zip>1</a><a class=c href=/u?a=1&amp;b=2 id=z>2</a><a href='q&quot;s'>3</a><a href=\"&#47;n&#x2F;m&#x2f;&#0047;\">4</a>"
        "<a href='&eacute;&NotEqualTilde;&hellip;'>5</a><a href='&unknown;&amp &#xD800;&#99999999999;&#0;&;x&'>6</a><a href=''>7</a><a href=>8</a>"
        "<a href='&#128512;&#x1F600;'>9</a><a\nhref =\n'y'>10</a>"
    )
    page = spark.createDataFrame([(html,)], "html string").select(listings.page_hrefs(F.col("html")).alias("h")).first()["h"]
    assert page == ["plain/x.zip", "/u?a=1&b=2", 'q"s', "/n/m//", "é≂̸…", "&unknown;&amp \ufffd\ufffd\ufffd&;x&", "", "😀😀", "y"]


T0 = datetime(2026, 3, 1)


def event_table(spark, data):
    rows_ = [
        (job, "2026-03", step, status, T0 + timedelta(minutes=i), error, None, i)
        for i, (job, step, status, error) in enumerate(data)
    ]
    return spark.createDataFrame(rows_, L.EVENT_SCHEMA)


EVENTS = [
    ("j", "load", "RUNNING", None), ("j", "load", "FAILED", "boom"), ("j", "extract", "SKIPPED", None),
    ("j", "load", "RUNNING", None), ("j", "load", "SUCCESS", None), ("k", "load", "RUNNING", None),
]


def test_rollup(spark):
    rollup = L.step_rollup(event_table(spark, EVENTS))
    got = {(r["job_id"], r["step_name"]): r for r in rollup.collect()}
    load = got["j", "load"]
    assert (load["status"], load["error"], load["writes"], load["runs"]) == ("SUCCESS", None, 4, 2)
    assert (load["started_at"], load["finished_at"]) == (T0 + timedelta(minutes=3), T0 + timedelta(minutes=4))
    assert (got["k", "load"]["status"], got["k", "load"]["finished_at"]) == ("RUNNING", None)
    assert [r["step_name"] for r in L.job_steps(rollup, "j").collect()] == ["load", "extract"]


def test_requeue_forgets_steps(spark):
    events = event_table(spark, [*EVENTS, ("j", "", "PENDING", None), ("j", "extract", "RUNNING", None)])
    assert rows(L.step_rollup(L.since_requeue(events)), "job_id", "step_name", "runs") == {
        ("j", "extract", 1), ("k", "load", 1)
    }


def test_runs(spark):
    data = [("a", "s", "RUNNING", None), ("a", "s", "FAILED", "x")] * 3 + [("b", "s", "PENDING", None), ("c", "s", "RUNNING", None)]
    runs = L.run_records(event_table(spark, data))
    got = {r["job_id"]: (r["status"], r["attempts"], r["last_error"]) for r in runs.collect()}
    assert got == {"a": ("DEAD", 3, "x"), "b": ("PENDING", 0, None), "c": ("RUNNING", 1, None)}
    now = F.lit("2026-03-02 00:00:00").cast("timestamp")
    assert rows(L.eligible_runs(runs, now), "job_id") == {("b",)}
    assert rows(L.next_run(runs, now), "job_id") == {("b",)}
    assert [r["job_id"] for r in L.recent_runs(runs, 2).collect()] == ["c", "b"]
    assert L.recent_runs(runs, -1).count() == 1 and L.recent_runs(runs).columns == list(L.RUN_COLUMNS)
    final = runs.select(final_status(F.col("status") == "SUCCESS", F.col("attempts"), F.col("max_attempts")).alias("s"), "job_id")
    assert rows(final, "job_id", "s") == {("a", "DEAD"), ("b", "FAILED"), ("c", "FAILED")}
    assert L.last_success(runs).first()["last_success_run_key"] is None


def test_requeue_clears_a_run(spark):
    """Back in the queue: attempts, lease, times and error are gone; a finished run keeps its lease until then."""
    used_up = [("a", "run", s, e) for s, e in (("RUNNING", None), ("FAILED", "x")) * 2 + (("RUNNING", None), ("DEAD", "y"))]
    before = L.run_records(event_table(spark, used_up)).first()
    assert (before["status"], before["attempts"], before["last_error"]) == ("DEAD", 3, "y")
    assert before["finished_at"] > before["started_at"] and before["lease_until"] is not None
    after = L.run_records(event_table(spark, [*used_up, ("a", "run", "PENDING", None)]))
    row = after.first()
    assert (row["status"], row["attempts"], row["last_error"]) == ("PENDING", 0, None)
    assert row["started_at"] is None and row["finished_at"] is None and row["lease_until"] is None
    assert row["created_at"] == before["created_at"]
    assert rows(L.eligible_runs(after, F.lit("2026-03-01").cast("timestamp")), "job_id") == {("a",)}
    failed = L.run_records(event_table(spark, used_up[:2]))
    lease = failed.first()["lease_until"]
    early, late = (F.lit(str(t)).cast("timestamp") for t in (before["created_at"], "2099-01-01"))
    assert lease > before["created_at"] and L.eligible_runs(failed, early).isEmpty() and not L.eligible_runs(failed, late).isEmpty()
    again = L.run_records(event_table(spark, [*used_up[:2], ("a", "run", "RUNNING", None)])).first()
    assert (again["status"], again["last_error"]) == ("RUNNING", "x")


def test_summary_and_counts(spark):
    data = [(f"j{i}", "s", "SUCCESS", None) for i in range(8)]
    runs = L.run_records(event_table(spark, data))
    got = [tuple(r) for r in L.status_summary(runs).orderBy("position").collect()]
    assert got[0] == (0, "2026-03", None, "SUCCESS") and [r[2] for r in got[1:]] == ["j7", "j6", "j5", "j4", "j3"]
    results = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    assert rows(L.outcome_counts(results, "ok")) == {(1, 2)}
    metrics = spark.createDataFrame([(1, None), (2, 3)], "a long, b long")
    assert rows(L.totals(metrics, ["a", "b"])) == {(3, 3)}
    assert rows(L.health(runs, spark.range(7))) == {("ok", "2026-03", 7)}


def test_event_log_and_stream(spark, tmp_path):
    log = RunEvents(spark, str(tmp_path / "events"))
    assert log.read().count() == 0
    for status in ("RUNNING", "SUCCESS"):
        log.append("j", "2026-03", "load", status)
    stream = spark.readStream.schema(L.EVENT_SCHEMA).parquet(str(tmp_path / "events"))
    for extra in (None, "SKIPPED"):
        if extra:
            log.append("j", "2026-03", "load", extra)
        keep_latest(live_rollup(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    latest = latest_rows(spark.read.parquet(str(tmp_path / "out")))
    assert rows(latest, "step_name", "status", "writes") == {("load", "SKIPPED", 3)}
    assert rows(latest, "status", "writes") == rows(L.step_rollup(log.read()), "status", "writes")


def test_versions(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    assert folder.current("t") is None
    first, second = folder.new_version("2026-02"), folder.new_version("2026-03")
    folder.write("t", first, spark.range(3))
    assert folder.current("t") is None
    folder.publish({"t": first}, "2026-02")
    reader = folder.current("t")
    folder.write("t", second, spark.range(5))
    assert folder.current("t").count() == 3
    folder.publish({"t": second, "u": first}, "2026-03")
    assert folder.current("t").count() == 5 and reader.count() == 3
    assert folder.current_versions() == {"t": second, "u": first}
    assert folder.publications().count() == 3


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for part, n in (("a", 2), ("b", 3), ("a", 1)):
        replace_partitions(spark.range(n).withColumn("run_key", F.lit(part)), path)
    assert rows(spark.read.parquet(path).groupBy("run_key").count()) == {("a", 1), ("b", 3)}


@pytest.mark.parametrize("configured", [True, False])
def test_work_folder_is_the_shared_one(spark, configured):
    from rollbook import session

    class Conf:
        def get(self, key, default):
            return "/shared/x/" if configured else None

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "spark://h:7077"

    if configured:
        assert session.work_dir(Fake, "p").startswith("/shared/x/p-")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.work_dir(Fake, "p")
