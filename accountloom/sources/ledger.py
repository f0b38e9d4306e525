"""What a run has finished, so that it can be repeated after a failure.

A run has a folder of small files, one per finished step. A step that may be done again is
simply left out once it is finished. An append may not: before it the files of the day are
noted, and after it those it added. A repeated run deletes what its unfinished append had
already put there and appends again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accountloom.sources import files, warehouse


class Ledger:
    """The ledger of one run; runs of different names know of each other's files."""

    def __init__(self, spark: SparkSession, base: str, run_id: str):
        if not run_id or "/" in run_id:
            raise ValueError(f"a run id has at least one character and no slash: {run_id!r}")
        self._spark, self._runs, self._own = spark, f"{base}/runs", f"{base}/runs/{run_id}"

    def _note(self, step: str, state: str, **facts) -> None:
        files.write_text(self._spark, f"{self._own}/{step}.{state}", json.dumps(facts))

    def _noted(self, step: str, state: str, run: str | None = None) -> dict | None:
        path = f"{run or self._own}/{step}.{state}"
        return json.loads(files.read_text(self._spark, path)) if files.exists(self._spark, path) else None

    def once(self, step: str, work: Callable[[], object]) -> None:
        """Do a step that may be repeated, unless it is finished."""
        if self._noted(step, "done") is None:
            work()
            self._note(step, "done")

    def _others(self, step: str) -> set[str]:
        """Files that other runs have added in the step."""
        found = set()
        for name in files.names(self._spark, self._runs):
            run = f"{self._runs}/{name}"
            if run != self._own and (done := self._noted(step, "done", run)):
                found.update(done["files"])
        return found

    def append_once(self, df: DataFrame, database: str, entity: str, day: str) -> None:
        """Append a day's rows of one entity to its raw table, unless that is finished.

        Only one run may load a day at a time. Raises if the day was replaced between
        an unfinished append and its repetition.
        """
        step = f"append-{day}-{entity}"
        if self._noted(step, "done") is not None:
            return
        place = lambda: warehouse.day_folder(self._spark, database, f"raw_{entity}", day)
        present = lambda: {n for n in files.names(self._spark, place()) if n.startswith("part-")}
        begun = self._noted(step, "begun")
        if begun is None:
            begun = {"place": place(), "files": sorted(present())}
            self._note(step, "begun", **begun)
        elif begun["place"] != place():
            raise RuntimeError(f"{entity} of {day} was replaced since this run began to append to it")
        elif extra := present() - set(begun["files"]):
            for name in extra - self._others(step):
                files.delete(self._spark, f"{place()}/{name}")
            self._spark.catalog.refreshTable(f"{database}.raw_{entity}")
        before = present()
        warehouse.append_raw({entity: df}, database)
        self._note(step, "done", files=sorted(present() - before))
