"""Stage tables: what a build has made is written once, marked as whole, and read by all that follows."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local master, where all run on one machine, may leave it unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        where = "/tmp/checkpoints"
    return where.rstrip("/")


_unnamed: list[Stages] = []


@atexit.register
def _drop_unnamed() -> None:
    for stages in _unnamed:
        try:
            stages.drop()
        except Exception:  # the session has ended before the interpreter
            return


class Stages:
    """Tables in a folder of their own, which goes at the interpreter's exit if it wasn't given. A table without its mark, which is made last, is made again, so that a
    build that starts once more in the same folder goes on where it ended."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_folder(spark)}/quillstone-build-{uuid.uuid4().hex}"
        #: Names of the stages that this object has made, not found.
        self.made: list[str] = []
        if not path:
            _unnamed.append(self)

    def _whole(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def keep(self, name: str, make: Callable[[], DataFrame], **counters: Column) -> tuple[DataFrame, dict[str, int]]:
        """The stage's table and its counters, which are observed while it is written and stay beside it."""
        path, counts = f"{self.path}/{name}", f"{self.path}/{name}.counts"
        last = counts if counters else path
        if not self._whole(last):
            frame = make()
            seen = Observation()
            if counters:
                frame = frame.observe(seen, *[c.cast("long").alias(n) for n, c in counters.items()])
            frame.write.mode("overwrite").parquet(path)
            if counters:
                schema = ", ".join(f"{n} long" for n in counters)
                got = seen.get
                self.spark.createDataFrame([tuple(got.get(n) or 0 for n in counters)], schema).coalesce(1).write.mode("overwrite").parquet(counts)
            self.made.append(name)
        found = self.spark.read.parquet(counts).first().asDict() if counters else {}
        return self.spark.read.parquet(path), found

    def drop(self) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
