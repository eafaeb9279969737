"""ZIP archives: listing, checking and unpacking, one task per archive or member.

A deflate stream cannot be read in parts, so the member is the smallest unit of work.
"""

from __future__ import annotations

import hashlib
import io
import sys
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# The helpers below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 8 * 1024 * 1024

CHECK_SCHEMA = "path string, problem string, detail string, sha256 string"
MEMBER_SCHEMA = "path string, position int, member string, size bigint"


def _open(path: str):
    """A seekable stream on any file system the cluster's Arrow build knows."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return system, inner


# Why an archive can't be used.
ABSENT, NO_BYTES, WRONG_SIZE, WRONG_SUM, UNREADABLE, DAMAGED = (
    "absent", "no bytes", "size differs", "checksum differs", "not readable", "damaged member",
)


def check_found(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, problem) of every expected file: null, or what is wrong by its listing alone.

    ``expected`` has a name and may have the size and sha256 that a listing gives; ``found`` has name, size and, if sums are to
    be compared, sha256. One join; no file is opened.
    """
    columns = {"size": "bigint", "sha256": "string"}
    e = expected.select("name", *[(F.col(c) if c in expected.columns else F.lit(None).cast(t)).alias(f"listed_{c}") for c, t in columns.items()])
    f = found.select("name", *[(F.col(c) if c in found.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()], F.lit(True).alias("there"))
    problem = (
        F.when(F.col("there").isNull(), ABSENT).when(F.col("size") == 0, NO_BYTES).when(F.col("listed_size") != F.col("size"), WRONG_SIZE)
        .when(F.col("listed_sha256") != F.col("sha256"), WRONG_SUM)
    )
    return e.join(f, "name", "left").select("name", problem.alias("problem"))


def flat_members(listed: DataFrame) -> DataFrame:
    """Members under their flat names (last component); entries of folders are left out."""
    name = F.element_at(F.split("member", "/"), -1)
    return listed.withColumn("name", name).filter(F.col("name") != "")


def first_of_name(members: DataFrame) -> DataFrame:
    """Of members that share a flat name the first one, by archive, then position."""
    return members.groupBy("name").agg(F.min(F.struct("path", "position", "size")).alias("first")).select("name", "first.*")


MAX_TASKS = 20_000


def one_per_task(df: DataFrame, column: str) -> DataFrame:
    """Spread a short list over as many tasks as it has rows.

    The number is given, because adaptive execution would merge partitions this small into one task.
    """
    return df.repartitionByRange(min(max(df.count(), 1), MAX_TASKS), column)


def _read_through(stream) -> tuple[str | None, str | None]:
    """Read every member to its end: (problem, what about it)."""
    member = None
    try:
        with zipfile.ZipFile(stream) as archive:
            for info in archive.infolist():
                member = info.filename
                with archive.open(info) as content:
                    while content.read(CHUNK):
                        pass
    except (zipfile.BadZipFile, ValueError, EOFError, OSError, NotImplementedError, RuntimeError, zlib.error) as exc:
        return (UNREADABLE, str(exc)) if member is None else (DAMAGED, member)
    return None, None


def read_through(files: DataFrame) -> DataFrame:
    """(path, problem, detail, sha256) of archives by path: members are read as streams, so an archive may exceed memory."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, inner = _open(path)
                info, digest, detail = system.get_file_info(inner), None, None
                problem = (None if info.size else NO_BYTES) if info.is_file else ABSENT
                if problem is None:
                    with closing(system.open_input_file(inner)) as stream:
                        problem, detail = _read_through(stream)
                if problem is None:
                    sha = hashlib.sha256()
                    with closing(system.open_input_file(inner)) as stream:
                        while chunk := stream.read(CHUNK):
                            sha.update(chunk)
                    digest = sha.hexdigest()
                yield pd.DataFrame({"path": [path], "problem": [problem], "detail": [detail], "sha256": [digest]})

    return one_per_task(files.select("path"), "path").mapInPandas(check, CHECK_SCHEMA)


def read_contents(held: DataFrame) -> DataFrame:
    """(path, problem, detail) of archives held as (path, content): every member is read to its end."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_read_through(io.BytesIO(c)) if c else (NO_BYTES, None) for c in batch["content"]]
            yield pd.DataFrame({"path": batch["path"], "problem": [p for p, _ in found], "detail": [d for _, d in found]}, dtype=object)

    return held.select("path", "content").mapInPandas(check, "path string, problem string, detail string")


def check_files(expected: DataFrame, found: DataFrame, folder: str) -> DataFrame:
    """(name, ok, sha256, error) of every expected archive. ``found`` has path, name and size of the files in ``folder``.

    What a listing tells is told by a join. Archives that pass it are opened, and those it lacks looked for, since Spark lists no
    files without content.
    """
    listed = check_found(expected, found).join(found.select("name", "path"), "name", "left")
    path = F.coalesce("path", F.concat(F.lit(folder.rstrip("/") + "/"), "name"))
    listed = listed.select("name", path.alias("path"), F.when(F.col("problem") != ABSENT, F.col("problem")).alias("problem"))
    opened = read_through(listed.filter("problem IS NULL")).withColumnRenamed("problem", "inner")
    problem = F.coalesce("problem", "inner")
    error = F.when(problem.isNotNull(), F.concat_ws(": ", problem, "detail"))
    return listed.join(opened, "path", "left").select("name", problem.isNull().alias("ok"), "sha256", error.alias("error"))


def list_members(paths: DataFrame) -> DataFrame:
    """Members per archive, from the archives' directories alone."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, inner = _open(path)
                with closing(system.open_input_file(inner)) as stream, zipfile.ZipFile(stream) as archive:
                    infos = archive.infolist()
                yield pd.DataFrame(
                    {
                        "path": [path] * len(infos),
                        "position": range(len(infos)),
                        "member": [i.filename for i in infos],
                        "size": [i.file_size for i in infos],
                    }
                )

    return one_per_task(paths.select("path"), "path").mapInPandas(members, MEMBER_SCHEMA)


def extract_files(paths: DataFrame, target: str) -> DataFrame:
    """Unpack archives into the shared folder ``target``; returns (path, name, bytes) per written file.

    Work is spread over members. Where two members share a flat name the first one (by archive, then
    position) is kept, and a file that is there with the member's size is left alone. Each task writes under
    a name of its own and renames at the end, so a task that runs twice does no harm.
    """
    spread = one_per_task(first_of_name(flat_members(list_members(paths))), "name")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, position, out_name, size in zip(batch["path"], batch["position"], batch["name"], batch["size"]):
                system, folder = _open(target)
                system.create_dir(folder, recursive=True)
                final = f"{folder.rstrip('/')}/{out_name}"
                info = system.get_file_info(final)
                if not (info.is_file and info.size == size):
                    part = f"{final}.{uuid.uuid4().hex}.tmp"
                    source, inner = _open(path)
                    with closing(source.open_input_file(inner)) as stream, zipfile.ZipFile(stream) as archive:
                        with archive.open(archive.infolist()[position]) as src, closing(
                            system.open_output_stream(part)
                        ) as dst:
                            while chunk := src.read(CHUNK):
                                dst.write(chunk)
                    system.move(part, final)
                    info = system.get_file_info(final)
                yield pd.DataFrame({"path": [path], "name": [out_name], "bytes": [info.size]})

    return spread.mapInPandas(extract, "path string, name string, bytes bigint")
