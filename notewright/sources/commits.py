"""What counts: the finished steps of a run, and the runs that a version of the marts holds.

Both are small JSON files. A file is written under a name of its own and put in place by one rename
that fails if the name is taken, so a reader sees a whole file or none, and of two writers one wins.

    journal/<run>/<step>.json      a step that is done, with what it found out
    versions/<number>.json         a version of the marts: its runs, in the order they came

The newest version is the one that counts; older ones stay and can still be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, for whatever store the path is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def partition_path(spark: SparkSession, path: str, run_id: str) -> str:
    """Where a table partitioned by run keeps one run."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    return f"{path}/run_id={escaped}"


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    files, place = _place(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def read(spark: SparkSession, path: str) -> dict | None:
    """What a file holds, or None if there is none."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return None
    lines = files.open(place)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(lines)))
    finally:
        lines.close()


def put(spark: SparkSession, path: str, content: dict) -> bool:
    """Put a file in place as a whole; False, and nothing happens, if the name is taken."""
    folder, _, name = path.rpartition("/")
    files, place = _place(spark, path)
    _, draft = _place(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    never_replacing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(place).toUri(), conf).rename(
            draft, place, never_replacing)
    except Py4JJavaError as failed:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in failed.java_exception.getClass().getName():
            return False
        raise
    return True


class Run:
    """The journal of a run. A step that is done is not done again."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.path = partition_path(spark, f"{folder}/journal", run_id)

    def found(self, step: str) -> dict | None:
        """What a finished step found out; None if it isn't finished."""
        return read(self.spark, f"{self.path}/{step}.json")

    def once(self, step: str, work: Callable[[], dict]) -> dict:
        """Do a step unless it is done, and return what it found out.

        A step must come out the same when it is done anew over what a lost attempt left.
        """
        found = self.found(step)
        if found is None:
            found = work()
            put(self.spark, f"{self.path}/{step}.json", found)
        return found

    def forget(self) -> None:
        """Let the run begin anew."""
        files, place = _place(self.spark, self.path)
        files.delete(place, True)


def version(spark: SparkSession, folder: str) -> tuple[int, list[dict]]:
    """The newest version and its runs, each {"run": id, ...}; (0, []) before the first."""
    numbers = [int(n.removesuffix(".json")) for n in names(spark, f"{folder}/versions") if n.endswith(".json") and n[0] != "."]
    if not numbers:
        return 0, []
    return max(numbers), read(spark, _version_path(folder, max(numbers)))["runs"]


def commit(spark: SparkSession, folder: str, run: dict) -> int:
    """Make a version that holds one more run, after whatever others have committed by then."""
    while True:
        number, runs = version(spark, folder)
        if any(r["run"] == run["run"] for r in runs):
            return number
        if put(spark, _version_path(folder, number + 1), {"runs": [*runs, run]}):
            return number + 1


def _version_path(folder: str, number: int) -> str:
    return f"{folder}/versions/{number:012d}.json"
