"""Which tables of a run are written, so that a run that stopped goes on where it was.

A run is a folder ``<root>/_ledger/<name>`` of empty files. ``<table>.begun.<microseconds>`` is made before
a table is written; the time becomes the audit time of all its rows. ``<table>.done`` is made after the write. When
all tables are done, the folder moves to ``_ledger/finished``: the next run of that name starts afresh.

A table that was begun but not done may be written in part, or in full without its mark. It is written again
with the same audit time, and rows that bear it already are dropped first. So nothing is added twice, not even rows with a NULL
key, which match nothing.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from novalake.sources.tables import fs_path

LEDGER = "_ledger"


def fingerprint(rows: DataFrame, keys: list[str]) -> str:
    """Tells one input from another: the files a scan reads, or else the keys of the rows."""
    try:
        files = rows.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        found = files.distinct()
        columns = found.columns
    except Exception as error:  # noqa: BLE001 - no scan of files, so there is no such column
        if "_metadata" not in str(error):
            raise
        found, columns = rows.select(*keys), keys
    mixed = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    count, total = found.agg(F.count("*"), F.coalesce(mixed, F.lit(0))).first()
    return f"{count}-{int(total) & (1 << 64) - 1:016x}"


class Ledger:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, f"{root.rstrip('/')}/{LEDGER}", name

    def _at(self, *names: str):
        return fs_path(self.spark, "/".join([self.root, *names]))

    def _marks(self) -> list[str]:
        fs, folder = self._at(self.name)
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _mark(self, mark: str) -> None:
        fs, file = self._at(self.name, mark)
        fs.create(file, True).close()

    def is_done(self, table: str) -> bool:
        return f"{table}.done" in self._marks()

    def begin(self, table: str) -> dt.datetime:
        """The audit time of the table's rows: that of the earlier attempt, if there was one."""
        earlier = [m for m in self._marks() if m.startswith(f"{table}.begun.")]
        micros = int(earlier[0].rsplit(".", 1)[1]) if earlier else time.time_ns() // 1000
        if not earlier:
            self._mark(f"{table}.begun.{micros}")
        return dt.datetime.fromtimestamp(micros // 10**6, dt.timezone.utc) + dt.timedelta(microseconds=micros % 10**6)

    def finish(self, table: str) -> None:
        self._mark(f"{table}.done")

    def close(self) -> None:
        """The run is over."""
        fs, folder = self._at(self.name)
        if fs.exists(folder):
            _, finished = self._at("finished")
            fs.mkdirs(finished)
            _, to = self._at("finished", f"{self.name}.{time.time_ns() // 1000}")
            fs.rename(folder, to)


def finished_runs(spark: SparkSession, root: str) -> list[str]:
    """Names of the runs that came to their end, oldest first."""
    fs, folder = fs_path(spark, f"{root.rstrip('/')}/{LEDGER}/finished")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [n.rsplit(".", 1)[0] for n in sorted(names, key=lambda n: int(n.rsplit(".", 1)[1]))]
