"""The monthly load: unpack, clean, check, merge or replace, rebuild the serving table.

Each step is an idempotent write to a new version and is recorded in the run events, so a run that was
interrupted goes on after the last finished step.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from rollbook.functions.keys import key_present
from rollbook.functions.status import DEAD, FAILED, MAX_ATTEMPTS, PENDING, RUNNING, SUCCESS
from rollbook.functions.text import file_name
from rollbook.operators import buckets, checks, cleaning, drops, ledger, merge
from rollbook.plans.served import SERVING, SERVING_SCHEMA, write_served
from rollbook.plans.serving import SERVING_COLUMNS, build_serving
from rollbook.session import build_session, work_dir
from rollbook.sources import archives, listings, raw_files
from rollbook.sources.registry import (
    LAYOUTS, MERGE, REPLACE, REPLACE_KEYED, Layout, stamped_schema,
)
from rollbook.sources.run_events import RunEvents
from rollbook.sources.tables import Part, TableFolder, read_if_there, small_table

log = logging.getLogger("rollbook.load")

METRIC_SCHEMA = "table string, rows bigint, skipped_empty bigint, skipped_invalid_required bigint, files bigint, note string"
LOAD_SCHEMA = "table string, inserted bigint, updated bigint, deleted bigint"
# Tables worked on at the same time.
PARALLEL_TABLES = 6
MERGED_SUFFIX = [T.StructField("op", T.StringType())]


@dataclass
class Options:
    run_key: str
    stamp: str = ""
    min_ratio: float = checks.MIN_RATIO
    multi_line: bool | dict[bool, list[str]] | None = None
    on_duplicate: str = "error"
    null_exempt_columns: tuple[str, ...] = ()
    check_lengths: bool = True
    force: bool = False
    buckets: int = buckets.BUCKETS
    layouts: Mapping[str, Layout] = field(default_factory=lambda: LAYOUTS)

    def __post_init__(self) -> None:
        if self.on_duplicate not in ("error", "first"):
            raise ValueError("on_duplicate is 'error' or 'first'")
        if not self.stamp:
            self.stamp = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")


def current_schema(layout: Layout) -> T.StructType:
    """Schema of a table's published rows."""
    if layout.policy == MERGE:
        return T.StructType(stamped_schema(layout).fields + MERGED_SUFFIX)
    if layout.policy == REPLACE:
        return T.StructType([T.StructField("id", T.LongType())] + stamped_schema(layout).fields)
    if layout.policy == REPLACE_KEYED:
        return T.StructType([f for f in stamped_schema(layout).fields if f.name != "created_at"])
    return layout.schema


def current_rows(
    folder: TableFolder, layout: Layout, versions: Mapping[str, str] | None = None
) -> DataFrame | None:
    """Published rows of a table; rows a merge deleted are left out by their partition."""
    df = folder.current(layout.name, current_schema(layout), versions)
    return merge.snapshot(df) if df is not None and layout.policy == MERGE else df


def discover(spark: SparkSession, raw: str, layouts: Mapping[str, Layout]) -> dict[str, list[str]]:
    """Files per table, found by name. One drop has a few dozen files."""
    found: dict[str, list[str]] = {}
    for row in raw_files.match_sources(raw_files.list_files(spark, raw), layouts.values()).collect():
        found.setdefault(row["table"], []).append(row["path"])
    return found


def transform(
    spark: SparkSession, folder: TableFolder, sources: Mapping[str, list[str]], options: Options
) -> DataFrame:
    """Clean every table of the drop into ``curated/<table>``; returns the counters.

    Every row is written once with its state as partition; the counters come from what was written, so
    a repeated task cannot count twice. A table without a file is left out with a note.
    """

    def one(layout: Layout) -> tuple:
        paths = sources.get(layout.name)
        if not paths:
            log.warning("%s: no file in the drop, the current table stays", layout.name)
            return (layout.name, 0, 0, 0, 0, "no file")
        raw_rows, blank = raw_files.scan_counted(spark, paths, layout, options.multi_line)
        cleaned = cleaning.clean_cells(raw_rows, layout.columns, options.null_exempt_columns)
        classified = cleaning.classify_rows(cleaned, layout.columns, layout.required)
        written = folder.write(f"curated/{layout.name}", options.run_key, classified, ["row_state"])
        m = cleaning.clean_metrics(written).first()
        return (layout.name, m["rows"], m["skipped_empty"] + blank, m["skipped_invalid_required"], len(paths), None)

    return small_table(spark, side_by_side(one, options.layouts.values()), METRIC_SCHEMA)


def side_by_side(work: Callable, items: Iterable) -> list:
    """Results of ``work`` for independent tables, a few at a time, so that small ones fill idle cores."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return list(pool.map(work, items))


def curated_rows(folder: TableFolder, layout: Layout, run_key: str) -> DataFrame | None:
    schema = T.StructType(layout.schema.fields + [T.StructField("row_state", T.StringType())])
    rows = read_if_there(folder.spark, folder.path(f"curated/{layout.name}", run_key), schema)
    return None if rows is None else rows.filter(F.col("row_state") == cleaning.KEPT).drop("row_state")


def merge_buckets(
    folder: TableFolder, layout: Layout, staging: DataFrame, options: Options, old: str | None, version: str
) -> Row:
    """Write ``version`` of a merged table from its ``old`` one and the dump; returns the counters.

    Buckets whose rows have one digest in the old version and in the dump hold nothing to merge: the new version names the
    folder they lie in, and nobody reads them. All others are merged, and only those are written.
    """
    name, key, n = layout.name, layout.key, options.buckets
    # One short row per bucket on either side.
    new = {r["bucket"]: r["digest"] for r in buckets.bucket_digests(staging, key, layout.data_columns, n).collect()}
    parts = folder.parts(name, old) if old else []
    known = {p.bucket: p for p in parts or [] if p.buckets == n}
    same = {b for b, p in known.items() if p.digest == new.get(b, "")}
    changed = [b for b in range(n) if b not in same]
    schema = current_schema(layout)
    if old is None:
        main = folder.spark.createDataFrame([], schema)
    elif known:
        main = folder.read_parts(name, old, schema, [known[b] for b in changed if b in known])
    else:  # written before there were buckets, or with another number of them
        main = folder.current(name, schema, {name: old})
    merged = merge.three_way_merge(
        merge.snapshot(main), buckets.in_buckets(staging, key, changed, n), key, layout.data_columns, options.run_key, options.stamp
    ).select(*[f.name for f in schema.fields], buckets.bucket_of(key, n).alias("bucket"))
    # Files follow buckets; Spark splits a large bucket over tasks and puts small ones together.
    written = folder.write(name, version, merged.hint("rebalance", F.col("bucket")), ["bucket", "op"])
    filled = {r[0] for r in written.select("bucket").distinct().collect()}
    made = [Part(n, b, version, new.get(b, ""), int(b in filled)) for b in changed]
    folder.write_parts(name, version, [*made, *(known[b] for b in sorted(same))])
    return merge.merge_counts(written).first()


def load_table(
    folder: TableFolder, layout: Layout, staging: DataFrame, options: Options, versions: Mapping[str, str]
) -> tuple[str, tuple[str, int, int, int]]:
    """Check one table and write its next version; returns that version and the counters."""
    name, merging = layout.name, layout.policy == MERGE
    main = current_rows(folder, layout, versions) if merging else None
    lengths = layout.lengths if options.check_lengths else {}
    report = checks.staging_report(main, staging, layout.key, lengths).first()
    if checks.too_small(report["main_rows"], report["staging_rows"], options.min_ratio):
        raise checks.volume_failed(name, report["main_rows"], report["staging_rows"], options.min_ratio)
    if report["long_rows"]:
        checks.require_lengths(staging, lengths, name)
    if report["duplicate_keys"]:
        keyed = staging.filter(key_present(layout.key))
        if options.on_duplicate == "error":
            checks.require_unique(keyed, layout.key, name)
        staging = checks.keep_first(keyed, layout.key, layout.data_columns)

    version = folder.new_version(options.run_key)
    if merging:
        counts = merge_buckets(folder, layout, staging, options, versions.get(name), version)
        return version, (name, counts["inserted"], counts["updated"], counts["deleted"])
    if layout.policy == REPLACE:
        new = merge.replace_all(staging, layout.columns, options.run_key, options.stamp, "id")
    elif layout.policy == REPLACE_KEYED:
        new = merge.replace_key_present(staging, layout.key, layout.columns, options.run_key, options.stamp)
    else:
        new = merge.replace_lookup(staging, layout.columns)
    return version, (name, folder.write(name, version, new).count(), 0, 0)


def load(
    spark: SparkSession, folder: TableFolder, options: Options, tables: list[str] | None = None,
    report: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """Load every curated table; unknown names are skipped with a warning. Returns the counters.

    Tables that passed are published even if another one fails; ``report`` then gets their counters, before
    the failure is raised.
    """
    versions = folder.current_versions()
    wanted = []
    for name in tables if tables is not None else list(options.layouts):
        if name in options.layouts:
            wanted.append(options.layouts[name])
        else:
            log.warning("%s: unknown table, skipped", name)

    def one(layout: Layout) -> tuple:
        staging = curated_rows(folder, layout, options.run_key)
        if staging is None:
            return layout.name, None, None
        try:
            version, counts = load_table(folder, layout, staging, options, versions)
        except Exception as exc:
            return layout.name, None, exc
        return layout.name, version, counts

    done = side_by_side(one, wanted)
    folder.publish({name: version for name, version, _ in done if version}, options.run_key)
    counters = small_table(spark, [counts for _, version, counts in done if version], LOAD_SCHEMA)
    failures = [(name, result) for name, _, result in done if isinstance(result, Exception)]
    if failures and report:
        report(counters)
    if failures:
        raise checks.CheckFailed("; ".join(str(exc) for _, exc in failures)) from failures[0][1]
    return counters


def refresh_serving(folder: TableFolder, options: Options) -> int:
    """Rebuild the serving table and what searches use beside it; readers keep the old version until all is complete."""
    versions = folder.current_versions()
    tables = {name: current_rows(folder, layout, versions) for name, layout in LAYOUTS.items()}
    absent = [name for name in ("empresas", "estabelecimentos") if tables[name] is None]
    if absent:
        raise checks.CheckFailed(f"never loaded: {', '.join(absent)}")
    version = folder.new_version(options.run_key)
    parts = write_served(folder, version, build_serving(tables))
    written = folder.read(SERVING, version)
    checks.require_rows(written, SERVING)
    folder.publish(parts, options.run_key)
    return written.count()


def serving_rows(folder: TableFolder) -> DataFrame | None:
    df = folder.current(SERVING, SERVING_SCHEMA)
    return None if df is None else df.select(*SERVING_COLUMNS)


def verify_archives(spark: SparkSession, folder: str, names: DataFrame) -> DataFrame:
    """The integrity report of the expected archives: (name, ok, sha256, error), one row each."""
    found = raw_files.list_files(spark, folder).withColumnRenamed("length", "size")
    # Every archive is read once: the report is written before anything looks at it.
    written = work_dir(spark, "archive-check")
    report = archives.check_files(names, found, folder)
    report.write.parquet(written)
    return spark.read.schema(report.schema).parquet(written)


def require_sound(report: DataFrame) -> None:
    """Raises if an archive of a report is damaged."""
    bad = report.agg(F.count_if(~F.col("ok")).alias("n"), F.min_by(F.struct("name", "error"), F.when(~F.col("ok"), F.col("name"))).alias("first")).first()
    if bad["n"]:
        raise checks.CheckFailed(f"damaged archives: {bad['n']}, the first {bad['first']['name']}: {bad['first']['error']}")


def require_found(expected: DataFrame, found: DataFrame) -> None:
    """Raises if an expected archive (by ``name``) was not found."""
    gone = expected.select("name").distinct().join(found.select("name"), "name", "left_anti").agg(F.count("*").alias("n"), F.min("name").alias("first")).first()
    if gone["n"]:
        raise checks.CheckFailed(f"missing archives: {gone['n']}, the first {gone['first']}")


def require_listed_sizes(expected: DataFrame, found: DataFrame) -> None:
    """Raises if an archive has another size than its listing says; a listing without a size says nothing."""
    listed = expected.filter("size > 0").select("name", "size")
    bad = drops.manifest_check(listed, found.join(listed.select("name"), "name", "left_semi")).filter("problem = 'size differs'")
    first = bad.agg(F.count("*").alias("n"), F.min(F.struct("name", "listed_size", "found_size")).alias("first")).first()
    if first["n"]:
        name, listed_size, found_size = first["first"]
        raise checks.CheckFailed(f"archives of another size than listed: {first['n']}, the first {name}: {found_size} instead of {listed_size} bytes")


class LoadFailed(RuntimeError):
    pass


def run_steps(
    events: RunEvents, job_id: str, run_key: str, steps: list[tuple[str, Callable[[], object]]], force: bool = False,
    max_attempts: int = MAX_ATTEMPTS,
) -> None:
    """Run the steps in order, leaving out those that succeeded since the job was last requeued."""
    rollup = ledger.step_rollup(ledger.since_requeue(events.read())).filter(F.col("job_id") == job_id)
    # One row per step of one job.
    known = {r["step_name"]: r for r in rollup.select("step_name", "status", "runs").collect()}
    todo = [(n, s) for n, s in steps if force or n not in known or known[n]["status"] != SUCCESS]
    if not todo:
        log.info("%s: nothing to do", job_id)
        return
    if not force and ledger.WHOLE_RUN in known and known[ledger.WHOLE_RUN]["status"] == DEAD:
        raise LoadFailed(f"{job_id}: no attempt left; force it to start anew")
    attempts = 1 + (known[ledger.WHOLE_RUN]["runs"] if ledger.WHOLE_RUN in known else 0)
    events.append(job_id, run_key, ledger.WHOLE_RUN, RUNNING)
    for name, step in todo:
        events.append(job_id, run_key, name, RUNNING)
        try:
            result = step()
        except Exception as exc:
            error = str(exc)
            events.append(job_id, run_key, name, FAILED, error=error)
            outcome = DEAD if attempts >= max_attempts else FAILED
            events.append(job_id, run_key, ledger.WHOLE_RUN, outcome, error=f"{name}: {error}")
            raise LoadFailed(f"{name}: {exc}") from exc
        events.append(job_id, run_key, name, SUCCESS, artifact_path=None if result is None else str(result))
    events.append(job_id, run_key, ledger.WHOLE_RUN, SUCCESS)


def run_load(
    spark: SparkSession, root: str, raw: str, options: Options, archive_folder: str | None = None,
    max_files: int | None = None, dry_run: bool = False, sources: Mapping[str, list[str]] | None = None,
    expected: DataFrame | None = None,
) -> str:
    """One drop from raw files (or archives) to the serving table; returns the job id.

    Files are matched to tables by name below ``raw``, unless ``sources`` gives them.

    A dry run stops after cleaning and uses the ``max_files`` smallest archives only; a real load takes all.
    ``expected`` is the drop's listing: the load fails before it reads anything if a wanted archive of it is missing.
    Archives are unpacked below their run key, into a new folder each time the run goes back to the queue.
    """
    if max_files is not None and not dry_run:
        raise ValueError("max_files is for dry runs: a load of some archives would delete the rows of the others")
    folder = TableFolder(spark, root)
    events = RunEvents(spark, f"{root.rstrip('/')}/run_events")
    job_id = f"{'dry-' if dry_run else ''}load-{options.run_key}"
    if options.force:
        events.append(job_id, options.run_key, ledger.WHOLE_RUN, PENDING)

    if archive_folder:
        requeued = ledger.whole_runs(events.read()).filter((F.col("job_id") == job_id) & (F.col("status") == PENDING)).count()
        raw = f"{raw.rstrip('/')}/run_key={options.run_key}/requeued={requeued}"

    def metrics_path(name: str) -> str:
        return f"{root.rstrip('/')}/metrics/{name}/run_key={options.run_key}"

    def metrics(name: str, df: DataFrame) -> str:
        df.write.mode("overwrite").json(metrics_path(name))
        return metrics_path(name)

    steps: list[tuple[str, Callable[[], object]]] = []
    if archive_folder:

        def chosen() -> DataFrame:
            listing = raw_files.list_files(spark, archive_folder)
            found = drops.wanted_files(listing.withColumnRenamed("length", "size"))
            if expected is not None:
                require_found(drops.wanted_files(expected), found)
                if "size" in expected.columns:
                    require_listed_sizes(drops.wanted_files(expected), found)
            return found if max_files is None else drops.smallest_files(found, max_files)

        def verify_step() -> str:
            written = metrics("verify", verify_archives(spark, archive_folder, chosen().select("name")))
            require_sound(spark.read.schema("name string, ok boolean, sha256 string, error string").json(written))
            return written

        steps += [
            ("verify", verify_step),
            ("extract", lambda: metrics("extract", archives.extract_files(chosen(), raw))),
        ]

    def transform_step() -> str:
        found = sources if sources is not None else discover(spark, raw, options.layouts)
        return metrics("transform", transform(spark, folder, found, options))

    def load_step() -> str:
        # Eleven rows: only tables this drop brought a file for are loaded.
        report = spark.read.schema(METRIC_SCHEMA).json(metrics_path("transform"))
        brought = {r["table"] for r in report.filter("files > 0").select("table").collect()}
        tables = [t for t in options.layouts if t in brought]
        # A retry finds the published tables unchanged: what the failed attempt did stays on record.
        return metrics("load", load(
            spark, folder, options, tables, lambda done: done.write.mode("append").json(metrics_path("load_partial"))
        ))

    steps.append(("transform", transform_step))
    if not dry_run:
        steps += [
            ("load", load_step),
            ("serve", lambda: refresh_serving(folder, options)),
        ]
    run_steps(events, job_id, options.run_key, steps, options.force)
    metrics("status", ledger.status_summary(ledger.run_records(ledger.whole_runs(events.read()))))
    return job_id


def run_drop(
    spark: SparkSession, root: str, raw: str, archive_folder: str, listing: DataFrame, run_key: str | None = None,
    force: bool = False, check_only: bool = False, **settings,
) -> dict:
    """From a listing of the source to the load: month, wanted files, decision, manifest, run.

    The month is the latest one named in the listing, unless given. Nothing is written when ``check_only`` is
    set or nothing is to be done. The manifest is saved before the run, so that the same files do not start a
    second one; a run that failed on them is resumed. ``settings`` are those of ``Options``.
    """
    key = run_key or drops.latest_month(listing).first()["run_key"]
    month = F.lit(key).alias("run_key")
    wanted = drops.wanted_files(listing).select(month, "*")
    path = f"{root.rstrip('/')}/manifests/run_key={key}"
    try:
        old = listings.read_manifest(spark, path, one_document=False)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        old = spark.createDataFrame([], "run_key string, name string, etag string")
    events = RunEvents(spark, f"{root.rstrip('/')}/run_events")
    runs = ledger.run_records(ledger.whole_runs(events.read())).filter(F.col("job_id") == f"load-{key}")
    # One row: the one run key.
    found = drops.load_decisions(old, wanted, runs).first()
    if found is None:
        raise LoadFailed(f"{key}: the listing names no wanted archive")
    decision = drops.LOAD if force else found["decision"]
    answer = {"run_key": key, "files": found["files"], "decision": decision, "job_id": None}
    if check_only or decision not in (drops.LOAD, drops.RESUME):
        return answer
    if decision == drops.LOAD:
        listings.write_manifest(wanted, key, path)
    options = Options(key, force=decision == drops.LOAD and not runs.isEmpty(), **settings)
    return {**answer, "job_id": run_load(spark, root, raw, options, archive_folder, expected=wanted)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Load one monthly drop")
    parser.add_argument("--root", required=True, help="folder of the versioned tables")
    parser.add_argument("--raw", required=True, help="folder of the raw files")
    parser.add_argument("--archives", help="folder of the ZIP archives to unpack into --raw")
    parser.add_argument("--run-key", help="YYYY-MM; with --listing: the latest month in it")
    parser.add_argument("--listing", help="saved XML listing of the source: decides what to load from --archives")
    parser.add_argument("--check-only", action="store_true", help="with --listing: only say what would be done")
    parser.add_argument("--force", action="store_true", help="run again even if done before")
    parser.add_argument("--dry-run", action="store_true", help="stop after cleaning")
    parser.add_argument("--max-files", type=int, help="with --archives and --dry-run: the k smallest only")
    parser.add_argument("--single-line", action="store_true", help="no field spans lines: skip the check for it")
    args = parser.parse_args(argv)
    if not args.run_key and not args.listing or args.listing and not args.archives:
        parser.error("give --run-key, or --listing together with --archives")
    spark = build_session()
    multi_line = False if args.single_line else None
    options = Options(args.run_key, multi_line=multi_line, force=args.force)
    try:
        if args.listing:
            print(json.dumps(run_drop(
                spark, args.root, args.raw, args.archives, listings.read_listing(spark, args.listing), args.run_key,
                args.force, args.check_only, multi_line=multi_line,
            )))
            return 0
        job_id = run_load(spark, args.root, args.raw, options, args.archives, args.max_files, args.dry_run)
    except LoadFailed as exc:
        print(json.dumps({"run_key": args.run_key, "error": str(exc)}), file=sys.stderr)
        return 1
    print(json.dumps({"run_key": args.run_key, "job_id": job_id}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
