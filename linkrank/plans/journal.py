"""The runs of a workspace, in the order in which they began, each with the notes of its iterations.

A run takes a number of its own before it does anything else, and its notes lie below that number. So a later run
is found by its number, however short it is, and never mistaken for an earlier one that got further.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from linkrank.plans.workspace import Workspace

RUNS_SCHEMA = "run long, iterations long, last_iteration long, converged boolean, nodes long, damping double, threshold double"


class Note(NamedTuple):
    """What was noted last about a run; ``number`` 0 is its beginning."""

    run: int
    number: int
    values: dict


class Journal:
    """Notes in the folder ``_journal`` of a workspace, which readers of tables pass over.

    A note is a small text written by one task; it counts once its writer has committed it, so the note that a
    lost driver leaves half written is as good as none.
    """

    def __init__(self, workspace: Workspace) -> None:
        self.spark, self.path = workspace.spark, f"{workspace.location}/_journal"

    def begin(self, values: dict) -> int:
        """The number of a new run, whose first note has ``values``. Two runs that begin at once get different numbers."""
        run = max(self._numbers(self.path), default=0) + 1
        while True:
            try:
                self._write(run, 0, values, "errorifexists")
                return run
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                run += 1

    def note(self, run: int, number: int, values: dict) -> None:
        self._write(run, number, values, "overwrite")

    def runs(self) -> list[int]:
        """Numbers of all runs, the newest first."""
        return sorted(self._numbers(self.path), reverse=True)

    def last(self, run: int) -> Note | None:
        """The last note of a run, None where not even its beginning was written to the end."""
        folder = f"{self.path}/run={run:09d}"
        for number in sorted(self._numbers(folder), reverse=True):
            note = f"{folder}/number={number:09d}"
            if self._files(note).exists(self._hadoop_path(f"{note}/_SUCCESS")):
                return Note(run, number, json.loads(self.spark.read.text(note).first()["value"]))
        return None

    def newest(self) -> Note | None:
        """The last note of the newest run that has one."""
        return next((note for run in self.runs() if (note := self.last(run))), None)

    def table(self) -> DataFrame:
        """One row for each run: how far it got, and whether it converged."""
        notes = [note for run in reversed(self.runs()) if (note := self.last(run))]
        rows = [
            (x.run, len(x.values["rows"]), x.values["next"] - 1, x.values["converged"], x.values["n"], x.values["options"]["damping"], x.values["options"]["tol"])
            for x in notes
        ]
        return self.spark.createDataFrame(rows, RUNS_SCHEMA)

    def _write(self, run: int, number: int, values: dict, mode: str) -> None:
        row = self.spark.createDataFrame([(json.dumps(values),)], "value string")
        row.coalesce(1).write.mode(mode).text(f"{self.path}/run={run:09d}/number={number:09d}")

    def _numbers(self, folder: str) -> list[int]:
        path = self._hadoop_path(folder)
        files = self._files(folder)
        if not files.exists(path):
            return []
        names = (x.getPath().getName() for x in files.listStatus(path))
        return [int(n.partition("=")[2]) for n in names if n.startswith(("run=", "number="))]

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._hadoop_path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
