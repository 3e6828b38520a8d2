"""Stages of an audience, run side by side.

Each stage is a thread that waits for the stages it needs, then has Spark save its ids; Spark
schedules the jobs (in FAIR pools, if the session was started with spark.scheduler.mode=FAIR). A stage
that fails takes down those that need it, and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame

from .audience import Both, Builder, Leaf, intersect_all, union_all

WAITING, RUNNING, DONE, FAILED, SKIPPED, CANCELLED = "waiting", "running", "done", "failed", "skipped", "cancelled"


class Run:
    """One run of a tree's stages. save(name, ids) writes a stage and returns what reads it again."""

    def __init__(self, builder: Builder, data: dict | Leaf | Both, save: Callable[[str, DataFrame], DataFrame], threads: int = 4, pool: str = "audience"):
        self.builder, self.save, self.pool = builder, save, pool
        self.top = builder.stage(data)
        self.spark = builder.stages[self.top].frame.sparkSession
        self.tag = f"sluice-{uuid.uuid4().hex}"
        self.states = dict.fromkeys(self._needed(), WAITING)
        self.errors: dict[str, BaseException] = {}
        self._stopped = False
        # Stages come after those they need, so the earliest that waits in a thread can always go on.
        self._threads = ThreadPoolExecutor(threads, thread_name_prefix="stage")
        self._runs: dict[str, Future] = {}
        for name in self.states:
            self._runs[name] = self._threads.submit(self._run, name)
        self._threads.shutdown(wait=False)

    def _needed(self) -> list[str]:
        found, todo = set(), [self.top]
        while todo:
            name = todo.pop()
            if name not in found:
                found.add(name)
                todo += self.builder.stages[name].depends
        return [n for n in self.builder.stages if n in found]

    def _run(self, name: str) -> DataFrame | None:
        stage = self.builder.stages[name]
        inputs = [self._runs[d].result() for d in stage.depends]
        if self._stopped or any(x is None for x in inputs):
            self.states[name] = CANCELLED if self._stopped else SKIPPED
            return None
        self.states[name] = RUNNING
        context = self.spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", self.pool)
        context.setJobGroup(f"{self.tag}-{name}", f"stage {name}", True)
        context.addJobTag(self.tag)
        try:
            frame = stage.frame if not inputs else intersect_all(inputs) if isinstance(stage.rule, Both) and stage.rule.op == "$and" else union_all(inputs).distinct()
            out = self.save(name, frame)
            self.states[name] = DONE
            return out
        except Exception as e:
            self.errors[name] = e
            self.states[name] = CANCELLED if self._stopped else FAILED
            return None
        finally:
            context.removeJobTag(self.tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    def cancel(self) -> None:
        """Stop what runs, and begin nothing more."""
        self._stopped = True
        self.spark.sparkContext.cancelJobsWithTag(self.tag)

    def progress(self) -> dict[str, tuple[str, int, int]]:
        """For each stage its state, and the tasks of its jobs that are done and that there are so far."""
        tracker = self.spark.sparkContext.statusTracker()
        out = {}
        for name, state in list(self.states.items()):
            done = total = 0
            for job in tracker.getJobIdsForGroup(f"{self.tag}-{name}"):
                info = tracker.getJobInfo(job)
                for s in info.stageIds if info else ():
                    if (x := tracker.getStageInfo(s)) is not None:
                        # Stages that a finished job could leave out have tasks that never run.
                        total += x.numCompletedTasks if info.status == "SUCCEEDED" else x.numTasks
                        done += x.numCompletedTasks
            out[name] = (state, done, total)
        return out

    def wait(self) -> DataFrame:
        """The ids of the whole tree. Raises the first error of a stage that failed."""
        for run in self._runs.values():
            run.result()
        if self._stopped:
            raise RuntimeError("the run was cancelled")
        if self.errors:
            raise next(iter(self.errors.values()))
        return self._runs[self.top].result()


def save_in(folder: str) -> Callable[[str, DataFrame], DataFrame]:
    """Stages as Parquet in a folder; one that is there already isn't made again."""
    from ..sources.files import file_system

    def save(name: str, ids: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        fs, done = file_system(ids.sparkSession, f"{path}/_SUCCESS")
        if not fs.exists(done):
            ids.write.mode("overwrite").parquet(path)
        return ids.sparkSession.read.schema(ids.schema).parquet(path)

    return save
