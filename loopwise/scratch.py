"""Tables that a run writes for itself, in the folder that the cluster shares, and output that appears whole or not at all."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

_written: list[str] = []
_tables: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; on a single machine a temporary one where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="loopwise-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which ``clear`` removes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """(name, path) of a new catalog table in the shared folder, which ``clear`` removes."""
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    _tables.append(table)
    return table, path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, so a lost executor costs one step."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, jobs: list[Callable[[], T]]) -> list[T]:
    """What the jobs return, run at the same time: short Spark jobs leave most cores idle, and planning all of them."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, as a table may lie anywhere Spark can write."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def clear(spark: SparkSession) -> None:
    """Remove the scratch tables of this process. Results that were not written elsewhere can't be read any more."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _written:
        remove(spark, _written.pop())


@contextmanager
def committed(spark: SparkSession, out: str) -> Iterator[str]:
    """A folder to write to that takes the place of ``out`` at the end; after an error it is removed and ``out`` stays as it was."""
    begun = f"{out.rstrip('/')}-begun-{uuid.uuid4().hex[:8]}"
    try:
        yield begun
    except BaseException:
        remove(spark, begun)
        raise
    files, source = _files(spark, begun)
    target = _files(spark, out)[1]
    old = _files(spark, f"{begun}-old")[1]
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"cannot replace {out}; the new files are in {begun}")
    if not files.rename(source, target):
        if files.exists(old):
            files.rename(old, target)
        raise OSError(f"cannot move {begun} to {out}")
    files.delete(old, True)


_JOURNAL, _STAGED = ".journal", ".staged-"


class Change:
    """Several tables of a folder that are replaced together, or not at all.

    New files are written below a hidden folder. ``commit`` first writes a
    journal of what has to be moved where, and then moves it. Before the
    journal is there, the old tables are whole; from then on whoever opens the
    folder completes the moves (``complete``), each of which can be repeated.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.staged = f"{self.path}/{_STAGED}{uuid.uuid4().hex[:8]}"
        self.moves: list[tuple[str, str]] = []

    def place(self, name: str) -> str:
        """Where to write the new ``name`` (a table, or a partition of one), which takes the place of the old one."""
        self.moves.append((f"{self.staged}/{name}", f"{self.path}/{name}"))
        return self.moves[-1][0]

    def drop(self, name: str) -> None:
        self.moves.append(("", f"{self.path}/{name}"))

    def commit(self) -> None:
        files, journal = _files(self.spark, f"{self.path}/{_JOURNAL}")
        begun = _files(self.spark, f"{self.staged}/{_JOURNAL}")[1]
        out = files.create(begun)
        out.write(bytearray(json.dumps({"staged": self.staged, "moves": self.moves}).encode()))
        out.close()
        if files.exists(journal) or not files.rename(begun, journal):
            raise OSError(f"another change of {self.path} is being made")
        complete(self.spark, self.path)

    def give_up(self) -> None:
        remove(self.spark, self.staged)


def journalled(spark: SparkSession, path: str) -> bool:
    """Whether a change of the folder has begun to take effect and isn't done."""
    files, journal = _files(spark, f"{path.rstrip('/')}/{_JOURNAL}")
    return files.exists(journal)


def months_of(spark: SparkSession, table: str) -> list[str]:
    """Names of the partition folders of a table: one for each month."""
    files, where = _files(spark, table)
    return sorted(x.getPath().getName() for x in files.listStatus(where) if x.isDirectory() and "=" in x.getPath().getName())


def complete(spark: SparkSession, path: str) -> None:
    """Finish a change of the folder that has begun to take effect, if there is one."""
    files, journal = _files(spark, f"{path.rstrip('/')}/{_JOURNAL}")
    if not files.exists(journal):
        return
    stream = files.open(journal)
    plan = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for n, (source, target) in enumerate(plan["moves"]):
        old = _files(spark, f"{plan['staged']}/.old-{n}")[1]
        there = _files(spark, target)[1]
        new = _files(spark, source)[1] if source else None
        if new is None or files.exists(new):
            if files.exists(there) and not files.exists(old) and not files.rename(there, old):
                raise OSError(f"cannot replace {target}")
            if new is not None:
                files.mkdirs(there.getParent())
                if not files.rename(new, there):
                    raise OSError(f"cannot move {source} to {target}")
    files.delete(journal, False)
    remove(spark, plan["staged"])


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> int:
    """Write ``df`` as Parquet (partitioned by the column ``by``), read it back, and raise unless it holds as many rows as were written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode)
    (writer.partitionBy(by) if by else writer).parquet(path)
    wrote, there = seen.get["n"], df.sparkSession.read.parquet(path).count()
    if wrote != there:
        raise RuntimeError(f"{path} holds {there} rows, {wrote} were written")
    return there
