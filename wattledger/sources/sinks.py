"""Sinks: whole snapshots, slices that are replaced as a whole, and the report file."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")

# Hidden folders of a sliced table; readers of the table pass over names that start like this.
ATTEMPT, COMMIT = "_attempt-", "_commit"

# A store answers so many calls at once; one call after another, thousands of slices take minutes.
CALLS_AT_ONCE = 16
# Up to so many slices are listed one by one, more with the whole table.
LISTED_ALONE = 200
# Tasks that list the folders of a table; by default Spark starts one for each folder.
LISTING_TASKS = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "64")


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces the whole table at `path`."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def _visible(name: str) -> bool:
    return not name.startswith(("_", "."))


def _each(act: Callable[[str], T], items: Iterable[str]) -> list[T]:
    """`act` on all items, several at once; the first error is raised."""
    with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
        return list(pool.map(act, items))


class Folder:
    """The files of one table, in whatever file system it lies."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._utils = spark._jvm.org.apache.commons.io.IOUtils
        self._found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
        self._jvm, self._array = spark._jvm, spark.sparkContext._gateway.new_array
        # As the file system itself names the root in what it lists.
        self._top = self._files.makeQualified(self._path(root))
        uri = self._top.toUri()
        self._scheme, self._host, self._base = uri.getScheme(), uri.getAuthority(), uri.getPath().rstrip("/")

    def at(self, name: str):
        # By its parts: names of slices may hold characters that a joined path would parse.
        return self._path(self._scheme, self._host, f"{self._base}/{name}") if name else self._top

    def exists(self, name: str) -> bool:
        return self._files.exists(self.at(name))

    def _below(self, statuses, above: str) -> list[str]:
        """The paths of what was listed, relative to a folder; they cross over to Python as one text."""
        count = len(statuses) if statuses else 0
        if not count:
            return []
        paths = self._array(self._jvm.java.lang.Object, count)
        self._jvm.java.lang.System.arraycopy(self._found(statuses), 0, paths, 0, count)
        text = self._jvm.org.apache.commons.lang3.StringUtils.join(paths, "\n")
        start = len(self.at(above).toString().rstrip("/")) + 1
        return sorted(path[start:] for path in text.split("\n"))

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder; nothing if there is none."""
        where = self.at(name)
        return self._below(self._files.listStatus(where), name) if self._files.exists(where) else []

    def slices(self, name: str, depth: int) -> list[str]:
        """The slices below a folder, relative to it: `depth` levels of key=value."""
        found = [""]
        for _ in range(depth):
            found = [
                f"{above}/{own}" if above else own
                for above in found for own in self.names("/".join(x for x in (name, above) if x))
                if "=" in own and _visible(own)
            ]
        return found

    def tree(self, name: str, depth: int) -> dict[str, list[str]]:
        """The slices below a folder, relative to it, with their files: `depth` levels of key=value,
        found in one call."""
        pattern = self._path(_escaped(self.at(name).toString()) + "/[^_.]*" + "/*" * depth)
        found: dict[str, list[str]] = {}
        for path in self._below(self._files.globStatus(pattern), name):
            *levels, file = path.split("/")
            if all("=" in x and _visible(x) for x in levels) and _visible(file):
                found.setdefault("/".join(levels), []).append(file)
        return found

    def files(self, name: str) -> list[str]:
        return [f for f in self.names(name) if _visible(f)]

    def move(self, name: str, to: str, made: bool = False) -> None:
        """`made`: the folder it goes to is there."""
        if not made:
            self._files.mkdirs(self.at(to).getParent())
        if not self._files.rename(self.at(name), self.at(to)):
            raise OSError(f"cannot move {name} to {to} in {self.root}")

    def delete(self, name: str) -> None:
        self._files.delete(self.at(name), True)

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        draft = f"{ATTEMPT}draft-{uuid.uuid4().hex}"
        out = self._files.create(self.at(draft))
        out.write(bytearray(text.encode()))
        out.close()
        self.move(draft, name)

    def read(self, name: str) -> str:
        opened = self._files.open(self.at(name))
        try:
            return bytes(self._utils.toByteArray(opened)).decode()
        finally:
            opened.close()


def _pending(folder: Folder) -> dict | None:
    """The replacement that is decided but may not be carried out yet."""
    return json.loads(folder.read(COMMIT)) if folder.exists(COMMIT) else None


def _held(folder: Folder, parts: Sequence[str], depth: int) -> dict[str, list[str]]:
    """The files that the table has in some slices."""
    if len(parts) > LISTED_ALONE:
        return folder.tree("", depth)
    return dict(zip(parts, _each(folder.files, parts), strict=True))


def _carry_out(folder: Folder, commit: dict, coming: dict[str, list[str]] | None = None) -> None:
    """Brings the new files into their slices and takes the old ones out. May be broken off anywhere
    and started again: each step looks at what is there, but for `coming`, the files that are known
    to wait. A folder that the table does not have yet is moved as a whole; slices that it has are
    brought up to date one by one, several at once."""
    attempt, depth = commit["attempt"], commit["depth"]
    coming = folder.tree(attempt, depth) if coming is None else coming
    # Every folder of the attempt that holds slices is in the commit.
    whole = {part.split("/")[0] for part in coming} - set(folder.names())
    rest = [part for part in commit["slices"] if part.split("/")[0] not in whole]
    old = _held(folder, rest, depth)

    def bring(part: str) -> None:
        new, held = commit["slices"][part], old.get(part, [])
        for file in coming.get(part, []):
            folder.move(f"{attempt}/{part}/{file}", f"{part}/{file}", bool(held))
        if not new and folder.exists(part):
            folder.delete(part)
        elif new:
            for file in held:
                if file not in new:
                    folder.delete(f"{part}/{file}")

    _each(lambda top: folder.move(f"{attempt}/{top}", top, True), sorted(whole))
    _each(bring, rest)
    folder.delete(COMMIT)
    folder.delete(attempt)


def replace_slice(
    df: DataFrame, path: str, keys: Sequence[str], slices: Sequence[Sequence[object]] = ()
) -> None:
    """Replaces the slices (values of `keys`, such as a run date or a product) that `df` holds.

    Other slices stay, so running it again changes nothing. Rows are written by the tasks that
    have them: no slice is gathered in one task. A slice named in `slices` that has no rows in
    `df` is cleared: what an earlier run left there is not part of the new result. Values may be
    null or hold any characters; Spark names their folders.

    The new rows are first written beside the table, where no reader sees them. One small file
    then decides the replacement of all slices at once, after which files are moved. Whoever loses
    its driver before that file leaves the old rows, after it the new ones: `read_slices` gives
    them either way, and the next replacement finishes the move first. A table has one writer at a
    time.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    unfinished = _pending(folder)
    if unfinished:
        _carry_out(folder, unfinished)
    attempt = f"{ATTEMPT}{uuid.uuid4().hex}"
    df.write.partitionBy(*keys).parquet(f"{path}/{attempt}")
    new = folder.tree(attempt, len(keys))
    if slices:
        # One row per slice to clear, written the same way: its folders have the names that count.
        key_schema = StructType([df.schema[k] for k in keys])
        cleared = spark.createDataFrame([tuple(s) for s in slices], key_schema).withColumn("_none", F.lit(1))
        cleared.coalesce(1).write.partitionBy(*keys).parquet(f"{path}/{attempt}/{COMMIT}")
        new = {part: [] for part in folder.tree(f"{attempt}/{COMMIT}", len(keys))} | new
    commit = {"attempt": attempt, "slices": new, "depth": len(keys), "schema": df.schema.json()}
    folder.write(COMMIT, json.dumps(commit))
    _carry_out(folder, commit, {part: files for part, files in new.items() if files})


def _listed(spark: SparkSession, reader: DataFrameReader, *paths: str) -> DataFrame:
    """The rows of folders, which are listed by a fixed number of tasks."""
    name, tasks = LISTING_TASKS
    before = spark.conf.get(name, None)
    spark.conf.set(name, tasks)
    try:
        return reader.parquet(*paths)
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def read_slices(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a table that `replace_slice` writes, also after a replacement broke off: all its
    slices are old before it was decided, and all are new after. Without a `schema` the types of
    the keys are those that Spark reads off the folders' names."""
    folder = Folder(spark, path)
    commit = _pending(folder)
    if commit is None:
        return _listed(spark, spark.read.schema(schema) if schema else spark.read, path)
    own, coming = [], []
    stored = folder.tree("", commit["depth"])
    for part, files in stored.items():
        if part not in commit["slices"]:
            own += [f"{part}/{f}" for f in files]
    for part, new in commit["slices"].items():
        for file in new:
            (own if file in stored.get(part, []) else coming).append(f"{part}/{file}")
    schema = schema or StructType.fromJson(json.loads(commit["schema"]))
    rows = spark.createDataFrame([], schema)
    for base, files in ((path, own), (f"{path}/{commit['attempt']}", coming)):
        if files:
            given = [folder.at(f if base == path else f"{commit['attempt']}/{f}").toString() for f in files]
            found = spark.read.schema(schema).option("basePath", base).parquet(*[_escaped(g) for g in given])
            rows = rows.unionByName(found)
    return rows


def _escaped(path: str) -> str:
    """`path` without a meaning as a pattern."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """The report as CSV part files with a header; text is quoted only where needed."""
    df.write.mode("overwrite").option("header", True).csv(path)
