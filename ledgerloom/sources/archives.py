"""Delimited members of ZIP archives as a Spark data source.

Every archive of a folder is one input partition per wanted member. A task
opens its archive where it lies, reads the directory at its end and streams the
lines of the one member out; neither an archive nor a member is ever whole in
memory, and no archive is opened on the driver. Region and year come from the
file name, so archives of other scopes are left out by name.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ARCHIVE_NAME = r"^(\d{4})_(.+)\.zip$"  # fixed value: year and region in an archive's name
MEMBER_LINES = "region string, year int, needle string, member string, line_no long, titles string, line string"
BATCH_LINES = 8192


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or of a local path."""
    return pafs.FileSystem.from_uri(path)


def archive_names(path: str) -> list[tuple[str, str, int]]:
    """(path, region, year) of the archives in a folder, by name."""
    system, folder = opened(path)
    found = []
    for info in system.get_file_info(pafs.FileSelector(folder)):
        named = re.match(ARCHIVE_NAME, info.base_name)
        if named and info.is_file:
            found.append((info.path, named.group(2), int(named.group(1))))
    return sorted(found)


def pick_member(names: Sequence[str], needle: str, exclude: str | None) -> str | None:
    """Of the CSV members that hold the needle and not the excluded text, the one of the shortest name."""
    fits = [n for n in names if needle in n and n.lower().endswith(".csv") and not (exclude and exclude in n)]
    return min(fits, key=lambda n: (len(n), n), default=None)


def records(lines: Iterator[str]) -> Iterator[str]:
    """Lines of a delimited text; a quoted field that runs over line ends makes one record."""
    held = ""
    for line in lines:
        held += line
        if '"' in held and _open_quote(held):
            continue
        yield held.rstrip("\r\n")
        held = ""
    if held:
        yield held.rstrip("\r\n")


def _open_quote(record: str) -> bool:
    """Whether a quote opened at the start of a field is still open at the end."""
    rest = re.sub(r'(^|;)"(?:[^"]|"")*"(?!")', r"\1", record)
    return re.search(r'(^|;)"', rest) is not None


class MemberPartition(InputPartition):
    def __init__(self, uri: str, path: str, region: str, year: int, needle: str):
        super().__init__(None)
        self.uri, self.path, self.region, self.year, self.needle = uri, path, region, year, needle


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.encoding = options["path"], options.get("encoding", "latin-1")
        self.needles, self.exclude = json.loads(options["needles"]), options.get("exclude")
        self.scopes = json.loads(options["scopes"]) if "scopes" in options else None

    def wanted(self, region: str, year: int) -> bool:
        return self.scopes is None or any(r.upper() == region.upper() and (y is None or y == year) for r, y in self.scopes)

    def partitions(self) -> list[MemberPartition]:
        scoped = [a for a in archive_names(self.uri) if self.wanted(a[1], a[2])]
        return [MemberPartition(self.uri, *archive, needle) for archive in scoped for needle in self.needles]

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty folder still gets one task
            return
        system, _ = opened(partition.uri)
        with system.open_input_file(partition.path) as file, zipfile.ZipFile(file) as archive:
            member = pick_member(archive.namelist(), partition.needle, self.exclude)
            if member is None:
                return
            with archive.open(member) as handle:
                lines = records(io.TextIOWrapper(handle, encoding=self.encoding, newline=""))
                titles, held, first = None, [], 0
                for number, line in enumerate(lines):
                    if not line:
                        continue
                    if titles is None:
                        titles = line
                        continue
                    held.append((number, line))
                    if len(held) == BATCH_LINES:
                        yield self._batch(partition, member, titles, held)
                        held = []
                if held:
                    yield self._batch(partition, member, titles, held)

    def _batch(self, partition: MemberPartition, member: str, titles: str, held: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(held)
        columns = [
            pa.array([partition.region] * n), pa.array([partition.year] * n, pa.int32()), pa.array([partition.needle] * n), pa.array([member] * n),
            pa.array([k for k, _ in held], pa.int64()), pa.array([titles] * n), pa.array([line for _, line in held]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in MEMBER_LINES.split(", ")])


class ArchiveMembers(DataSource):
    """``spark.read.format("archive_members")``: options path, needles (JSON list), exclude, scopes (JSON list of [region, year or null]), encoding."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBER_LINES

    def reader(self, schema) -> MemberReader:
        return MemberReader(dict(self.options))


# A field after its semicolon: a quoted part, if it begins with one, and what follows up to the next semicolon.
FIELD = r';((?:"[^"]*+(?:""[^"]*+)*+")?[^;]*+)'
QUOTED = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def cells_of(line: Column) -> Column:
    """The fields of a semicolon line; quotes at the start of a field hold semicolons and doubled quotes."""
    quote = F.lit('"')
    fields = F.regexp_extract_all(F.concat(F.lit(";"), line), F.lit(FIELD), F.lit(1))
    bare = F.transform(
        fields,
        lambda c: F.when(
            c.startswith('"') & c.rlike(QUOTED),
            F.concat(F.replace(F.regexp_extract(c, QUOTED, 1), F.lit('""'), quote), F.regexp_extract(c, QUOTED, 2)),
        ).otherwise(c),
    )
    return F.when(F.contains(line, quote), bare).otherwise(F.split(line, ";", -1))


def read_members(
    spark: SparkSession,
    path: str,
    needles: list[str],
    columns: list[str],
    exclude: str | None = None,
    scopes: list[tuple[str, int | None]] | None = None,
    encoding: str = "latin-1",
) -> DataFrame:
    """Rows of the wanted members of all archives of a folder: region, year, needle, member, line_no and the named columns.

    Each member's own title line tells where a column stands; columns it lacks
    and fields a short line lacks are NULL.
    """
    spark.dataSource.register(ArchiveMembers)
    reader = spark.read.format("archive_members").option("path", path).option("needles", json.dumps(needles)).option("encoding", encoding)
    if exclude:
        reader = reader.option("exclude", exclude)
    if scopes is not None:
        reader = reader.option("scopes", json.dumps(scopes))
    lines = reader.load()
    titles = F.transform(cells_of(F.col("titles")), lambda c: F.trim(c))
    placed = lines.withColumns({"_cells": cells_of(F.col("line")), "_titles": titles})
    at = {c: F.array_position("_titles", F.lit(c)).cast("int") for c in columns}
    return placed.select(
        "region", "year", "needle", "member", "line_no",
        *[F.when(p > 0, F.try_element_at("_cells", F.when(p > 0, p).otherwise(1))).alias(c) for c, p in at.items()],
    )


def write_archives(rows: DataFrame, path: str, order: str) -> int:
    """Write (region, year, member, line) rows as archives of latin-1 members, lines in the given order; returns how many.

    A task writes the archives it holds one after another, line by line. An
    archive appears under its name when it is complete, so a task that runs
    again does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(path)
        system.create_dir(folder, recursive=True)
        current, member, archive, handle, file, done = None, None, None, None, None, 0

        def close() -> None:
            nonlocal done, handle
            if archive is not None:
                handle.close()
                archive.close()
                file.close()
                system.move(f"{folder}/_{current[1]}_{current[0]}.part", f"{folder}/{current[1]}_{current[0]}.zip")
                done += 1

        for batch in batches:
            for row in batch.to_pylist():
                if (row["region"], row["year"]) != current:
                    close()
                    current, member = (row["region"], row["year"]), None
                    file = system.open_output_stream(f"{folder}/_{current[1]}_{current[0]}.part")
                    archive, handle = zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED), None
                if row["member"] != member:
                    if handle is not None:
                        handle.close()
                    member = row["member"]
                    handle = archive.open(member, "w")
                handle.write((row["line"] + "\n").encode("latin-1"))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    placed = rows.repartition("region", "year").sortWithinPartitions("region", "year", "member", order)
    return placed.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def write_texts(rows: DataFrame, path: str, order: str) -> int:
    """Write (file_name, line) rows as UTF-8 text files of those names, lines in the given order; returns how many files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(path)
        system.create_dir(folder, recursive=True)
        name, file, done = None, None, 0

        def close() -> None:
            nonlocal done
            if file is not None:
                file.close()
                system.move(f"{folder}/_{name}.part", f"{folder}/{name}")
                done += 1

        for batch in batches:
            for row in batch.to_pylist():
                if row["file_name"] != name:
                    close()
                    name = row["file_name"]
                    file = system.open_output_stream(f"{folder}/_{name}.part")
                file.write((row["line"] + "\n").encode())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    placed = rows.select("file_name", order, "line").repartition("file_name").sortWithinPartitions("file_name", order)
    return placed.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
