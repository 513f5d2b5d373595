"""Files of the engine: an immutable log of commits, and a lease (M-03, M-06, M-11, S-06, K-01).

State is a fold over commits. A commit is written to a hidden folder and becomes visible by one rename, so all of
its parts appear or none. Everything goes through Hadoop's file systems, as the warehouse may be anywhere.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark import schema

PARTS = {"observations": schema.OBSERVATION, "quarantine": schema.QUARANTINE, "source_state": schema.SOURCE_STATE, "ledger": schema.LEDGER}


class LeaseHeld(RuntimeError):
    """Another holder has the lease."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.path("log"))

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    # -- the log ----------------------------------------------------------------

    def commits(self) -> list[int]:
        """Sequence numbers of the visible commits, ascending."""
        return sorted(int(s.getPath().getName()) for s in self.fs.listStatus(self.path("log")) if s.getPath().getName().isdigit())

    def commit(self, parts: dict[str, DataFrame]) -> int:
        """Write ``parts`` (of PARTS) as the next commit; nothing is visible until all of them are written."""
        staged = f".staging-{uuid.uuid4().hex}"
        try:
            for name, rows in parts.items():
                rows.select(PARTS[name].names).write.parquet(f"{self.root}/log/{staged}/{name}")
            done = self.commits()
            seq = done[-1] + 1 if done else 1
            self.publish(self.path("log", staged), self.path("log", f"{seq:012d}"))
            return seq
        except BaseException:
            self.fs.delete(self.path("log", staged), True)
            raise

    def publish(self, staged, target) -> None:
        """Rename, and fail if the target exists: a plain rename would move the folder into it."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path().toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(staged, target, self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def read(self, part: str, since: int = 0) -> DataFrame:
        """Rows of one part over all commits after ``since``, with the commit's number as ``seq``."""
        wide = StructType([*PARTS[part].fields, StructField("seq", LongType())])
        paths = [f"{self.root}/log/{seq:012d}/{part}" for seq in self.commits() if seq > since and self.fs.exists(self.path("log", f"{seq:012d}", part))]
        if not paths:
            return self.spark.createDataFrame([], wide)
        rows = self.spark.read.schema(PARTS[part]).parquet(*paths)
        seq = F.regexp_extract(F.col("_metadata.file_path"), r"/log/(\d+)/", 1).cast("bigint")
        return rows.withColumn("seq", seq)

    # -- compaction -------------------------------------------------------------

    def write_snapshot(self, jobs: DataFrame, upto: int) -> None:
        """The fold up to a commit, so that later ones start there; sorted by key within its files."""
        staged = f".staging-{uuid.uuid4().hex}"
        jobs.repartition("dedup_key").sortWithinPartitions("dedup_key").write.parquet(f"{self.root}/{staged}")
        self.fs.mkdirs(self.path("snapshots"))
        self.publish(self.path(staged), self.path("snapshots", f"{upto:012d}"))

    def last_snapshot(self) -> tuple[int, DataFrame | None]:
        if not self.fs.exists(self.path("snapshots")):
            return 0, None
        found = sorted(int(s.getPath().getName()) for s in self.fs.listStatus(self.path("snapshots")) if s.getPath().getName().isdigit())
        return (found[-1], self.spark.read.parquet(f"{self.root}/snapshots/{found[-1]:012d}")) if found else (0, None)

    # -- the lease --------------------------------------------------------------

    def _read_lease(self, name: str) -> dict | None:
        where = self.path("locks", name)
        if not self.fs.exists(where):
            return None
        stream = self.fs.open(where)
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text else {"holder": "?", "expires": 0}

    def _write_lease(self, name: str, holder: str, seconds: float, overwrite: bool) -> bool:
        try:
            out = self.fs.create(self.path("locks", name), overwrite)
        except Exception:  # it exists: somebody was faster
            return False
        out.write(bytearray(json.dumps({"holder": holder, "expires": time.time() + seconds}).encode()))
        out.close()
        return True

    def acquire(self, holder: str, seconds: float = 300, name: str = "run") -> None:
        """M-11: lapsed leases go, all of them; then the file is created if absent, or the holder is named."""
        self.fs.mkdirs(self.path("locks"))
        for s in self.fs.listStatus(self.path("locks")):
            lease = self._read_lease(s.getPath().getName())
            if lease and lease["expires"] <= time.time():
                self.fs.delete(s.getPath(), False)
        if not self._write_lease(name, holder, seconds, False):
            held = self._read_lease(name) or {}
            raise LeaseHeld(f"{name} is held by {held.get('holder', 'another process')}")

    def renew(self, holder: str, seconds: float = 300, name: str = "run") -> None:
        """By its holder only; a lease that was lost is an error, not a silent miss."""
        lease = self._read_lease(name)
        if not lease or lease["holder"] != holder:
            raise LeaseHeld(f"{name} is no longer held by {holder}")
        self._write_lease(name, holder, seconds, True)

    def release(self, holder: str, name: str = "run") -> None:
        lease = self._read_lease(name)
        if lease and lease["holder"] == holder:
            self.fs.delete(self.path("locks", name), False)

    @contextmanager
    def lease(self, holder: str, seconds: float = 300, name: str = "run"):
        self.acquire(holder, seconds, name)
        try:
            yield
        finally:
            self.release(holder, name)
