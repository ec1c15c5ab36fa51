"""Model registry as a log of numbered commits.

A commit is one JSON file, named by its number, that is made whole and then put in place only if no file has that
name: of two writers at once, one finds the number taken, reads what the other wrote and tries again. Readers list
the folder, so they see whole commits or none. On a local or HDFS folder the last step is atomic; an object store must
offer a rename or create that fails if the name is taken.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors.exceptions.captured import convert_exception
from pyspark.sql import DataFrame, SparkSession, functions as F
from py4j.protocol import Py4JJavaError

from ratingloom.operators import registry

EVENTS = "model_name string, version string, stage string, run_id string, metric string, value double, commit long"
MOST_EVENTS = 10_000  # of one commit
RETRIES = 50


class RegistryLog:
    """Events of a registry under ``path``; every read sees the commits so far."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._folder)

    def latest(self) -> int:
        """Number of the last commit, 0 before the first."""
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return max((int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()), default=0)

    def events(self, upto: int | None = None) -> DataFrame:
        """All events of the commits up to a number, with the number as ``commit``."""
        upto = self.latest() if upto is None else upto
        if not upto:
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).json([f"{self.path}/{n:020d}.json" for n in range(1, upto + 1)])

    def stages(self) -> DataFrame:
        """The present stage of every version."""
        now = registry.current_stages(self.events().withColumn("registered_at", F.col("commit")))
        return now.drop("registered_at")

    def commit(self, change: Callable[[DataFrame], DataFrame], retries: int = RETRIES) -> int:
        """Add the events that ``change`` makes of the events so far; it is asked again whenever another commit came first.
        Returns the number of the commit, or of the last one if there is nothing to add."""
        for _ in range(retries):
            last = self.latest()
            rows = change(self.events(last)).select(*(c for c in self._names() if c != "commit")).limit(MOST_EVENTS + 1).collect()
            if len(rows) > MOST_EVENTS:
                raise ValueError(f"a commit holds {MOST_EVENTS} events at most")
            if not rows:
                return last
            lines = [json.dumps(r.asDict() | {"commit": last + 1}) for r in rows]
            if self._put(last + 1, "\n".join(lines) + "\n"):
                return last + 1
        raise RuntimeError(f"no commit in {retries} tries")

    def promote(self, version: str, stage: str, model_name: str) -> int:
        """Give a registered version a stage; the version that had it is archived by this. Unknown versions are refused."""

        def event(events: DataFrame) -> DataFrame:
            known = events.where((F.col("version") == version) & (F.col("model_name") == model_name))
            found = known.orderBy(F.desc("commit")).limit(1).withColumn("stage", F.lit(stage))
            if found.isEmpty():
                raise ValueError(f"unknown version {version} of {model_name}")
            return found

        return self.commit(event)

    @staticmethod
    def _names() -> list[str]:
        return [c.split(" ")[0] for c in EVENTS.split(", ")]

    def _put(self, number: int, text: str) -> bool:
        """Whether the commit got its number."""
        fs = self._jvm.org.apache.hadoop.fs
        draft, goal = fs.Path(f"{self.path}/.{uuid.uuid4().hex}.tmp"), fs.Path(f"{self.path}/{number:020d}.json")
        out = self._files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._files.getUri().getScheme() == "file":
                # a local rename would replace the file, a link does not
                paths = self._jvm.java.nio.file.Paths
                local = [paths.get(self._jvm.java.net.URI.create("file://" + p.toUri().getPath())) for p in (goal, draft)]
                self._jvm.java.nio.file.Files.createLink(*local)
                return True
            return bool(self._files.rename(draft, goal))
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise convert_exception(error.java_exception) from None
        finally:
            self._files.delete(draft, False)
