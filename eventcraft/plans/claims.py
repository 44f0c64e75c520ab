"""A trial ledger that several drivers write.

Every driver of a search names the same shared folder. A trial is claimed by creating a file
that must not exist yet, which the file system grants to one driver only; the owner touches its
claim while it fits. A claim that has not been touched for ``expiry_s`` by the file system's own
clock belongs to a dead driver: the next generation of the claim takes it over. Results are
files of their own, renamed into place when whole. Should an owner that was taken for dead come
back and finish too, the ledger holds the lowest generation's result, the same for every reader.

The folder has to lie on storage with an exclusive create (HDFS and its like, a shared mount);
a plain object store does not grant a claim to one driver only.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventcraft.plans.registry import exists

SCHEMA = "trial_id int, params string, score double, worker string, generation int"


class Claims:
    def __init__(self, spark: SparkSession, folder: str, worker: str | None = None,
                 expiry_s: float = 3600.0) -> None:
        self.spark, self.folder, self.expiry_s = spark, folder.rstrip("/"), expiry_s
        self.worker = worker or uuid.uuid4().hex[:12]
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        for part in ("claims", "results", "clock"):
            self._fs.mkdirs(self._path(f"{self.folder}/{part}"))

    def _create(self, name: str) -> bool:
        """Create an empty file; False where it exists. One of several callers gets True."""
        path = self._path(f"{self.folder}/{name}")
        if self._fs.getUri().getScheme() == "file":  # Hadoop's own create is not exclusive there
            return self.spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            return self._fs.createNewFile(path)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise

    def _touch(self, name: str) -> None:
        """Write the file anew: its time is then the file system's, not this driver's."""
        self._fs.create(self._path(f"{self.folder}/{name}"), True).close()

    def _now(self) -> int:
        name = f"clock/{self.worker}"
        self._touch(name)
        return self._fs.getFileStatus(self._path(f"{self.folder}/{name}")).getModificationTime()

    def _listed(self, part: str) -> dict[tuple[int, int], int]:
        """(trial, generation): time of last change, from file metadata; a few entries a trial."""
        out = {}
        for s in self._fs.listStatus(self._path(f"{self.folder}/{part}")):
            name = s.getPath().getName()
            if name[0] not in "_.":
                trial, generation = name.split(".")[:2]
                out[int(trial), int(generation)] = s.getModificationTime()
        return out

    def finished(self) -> set[int]:
        return {trial for trial, _ in self._listed("results")}

    def claim(self, trials: range | list[int]) -> tuple[int, int] | None:
        """(trial, generation) of the first trial that is neither finished nor held, now held by
        this worker; None if there is none."""
        done, held = self.finished(), self._listed("claims")
        newest = {}
        for (trial, generation), at in held.items():
            newest[trial] = max(newest.get(trial, (-1, 0)), (generation, at))
        now = self._now() if newest else 0
        for trial in trials:
            generation, at = newest.get(trial, (-1, 0))
            if trial in done or (generation >= 0 and now - at < self.expiry_s * 1000):
                continue
            if self._create(f"claims/{trial}.{generation + 1}"):
                # the last owner may have finished after the results were listed
                if trial in self.finished():
                    continue
                return trial, generation + 1
        return None

    @contextmanager
    def held(self, trial: int, generation: int) -> Iterator[None]:
        """Touch the claim three times an expiry while the block runs."""
        stop = threading.Event()

        def beat() -> None:
            while not stop.wait(self.expiry_s / 3):
                self._touch(f"claims/{trial}.{generation}")
        t = threading.Thread(target=beat, daemon=True)
        if self.expiry_s > 0:
            t.start()
        try:
            yield
        finally:
            stop.set()
            if t.is_alive():
                t.join()

    def finish(self, trial: int, generation: int, params: dict, score: float | None) -> None:
        row = {"trial_id": trial, "params": json.dumps(params, sort_keys=True), "score": score,
               "worker": self.worker, "generation": generation}
        part = self._path(f"{self.folder}/results/_{trial}.{generation}.{uuid.uuid4().hex}")
        stream = self._fs.create(part, True)
        stream.write(bytearray(json.dumps(row), "utf-8"))
        stream.close()
        self._fs.rename(part, self._path(f"{self.folder}/results/{trial}.{generation}.json"))

    def run(self, plan: list[dict], fit: Callable[[dict], float | None], most: int | None = None,
            poll_s: float = 5.0) -> list[int]:
        """Fit trials of ``plan`` until all are finished, by this worker or others; those it
        fitted itself, at most ``most``. A trial whose fit raises stays claimed until it expires."""
        own: list[int] = []
        while most is None or len(own) < most:
            got = self.claim(range(len(plan)))
            if got is None:
                if len(self.finished() & set(range(len(plan)))) == len(plan):
                    break
                time.sleep(poll_s)  # others are at work; one of them may die
                continue
            with self.held(*got):
                score = fit(plan[got[0]])
            self.finish(*got, plan[got[0]], score)
            own.append(got[0])
        return own


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each finished trial: trial_id, params, score, worker, generation."""
    path = f"{folder.rstrip('/')}/results"
    rows = (spark.read.schema(SCHEMA).json(path) if exists(spark, path)
            else spark.createDataFrame([], SCHEMA))
    first = F.min_by(F.struct("params", "score", "worker", "generation"), "generation").alias("r")
    return rows.groupBy("trial_id").agg(first).select("trial_id", "r.*")
