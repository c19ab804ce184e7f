"""The sent ledger on a shared file system, cheap to read after a million polls.

    <path>/sent_day=2024-01-15/part=run-7/...     marks of run 7 on that day
    <path>/sent_day=2024-01-15/part=base-3/...    marks of many runs in few files
    <path>/sent_day=2024-01-15/_manifest-3.json   which base counts, and for which runs
    <path>/_runs/7/2024-01-15                     days on which run 7 left marks

The day comes first, so a poll lists the folders of the days it asks for and no others.
A run replaces its own folder of a day and nothing else. Compaction writes a new base and
publishes it with one manifest: a reader takes the newest manifest, its base and the run
folders it does not cover, so it sees the old files or the new ones, never both and never
neither. A run that is repeated after compaction is taken out of the base by a manifest.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.config import LEDGER_DAYS, LEDGER_KEEP
from apptflow.operators.ledger import LEDGER_KEY, ledger_rollover
from apptflow.session import written_once

LEDGER_SCHEMA = "kind string, key string, sent_at timestamp_ntz"
_STORED = LEDGER_SCHEMA + ", run string, sent_day date, part string"
FILE_BYTES = 128 << 20
_RUN, _BASE, _MANIFEST = "run-", "base-", "_manifest-"


# ----------------------------------------------------------------------- the folder


class _Folder:
    """The few file system calls a ledger needs, on any store Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder; nothing if it is not there."""
        at = self._at(name)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """A file that appears whole or not at all; one of that name may not exist."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.path}/{name} was published by another job")

    def touch(self, name: str) -> None:
        self._fs.create(self._at(name), True).close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def size(self, name: str) -> int:
        return self._fs.getContentSummary(self._at(name)).getLength()


@dataclass
class _Day:
    """The files of one day that count."""

    name: str
    parts: list[str] = field(default_factory=list)  # all parts that are there
    version: int = 0  # of the newest manifest, 0 if none
    base: str | None = None
    covers: set[str] = field(default_factory=set)  # run parts whose marks are in the base
    replaced: set[str] = field(default_factory=set)  # runs whose marks in the base do not count
    keep: int | None = None  # marks per kind that the base was trimmed to

    @property
    def loose(self) -> list[str]:
        return [p for p in self.parts if p.startswith(_RUN) and p not in self.covers]

    @property
    def live(self) -> list[str]:
        return self.loose + ([self.base] if self.base else [])

    def manifest(self) -> str:
        return json.dumps(
            {
                "base": self.base,
                "covers": sorted(self.covers),
                "replaced": sorted(self.replaced),
                "keep": self.keep,
            }
        )


def _day(folder: _Folder, day: date) -> _Day:
    out = _Day(f"sent_day={day.isoformat()}")
    names = folder.names(out.name)
    out.parts = [n.removeprefix("part=") for n in names if n.startswith("part=")]
    versions = [int(n.removeprefix(_MANIFEST).removesuffix(".json")) for n in names if _is_manifest(n)]
    if versions:
        out.version = max(versions)
        stored = json.loads(folder.read(f"{out.name}/{_MANIFEST}{out.version}.json"))
        out.base, out.keep = stored["base"], stored["keep"]
        out.covers, out.replaced = set(stored["covers"]), set(stored["replaced"])
    return out


def _is_manifest(name: str) -> bool:
    return name.startswith(_MANIFEST) and name.endswith(".json")


def _publish(folder: _Folder, day: _Day) -> None:
    day.version += 1
    folder.write_new(f"{day.name}/{_MANIFEST}{day.version}.json", day.manifest())


# --------------------------------------------------------------------------- reading


def ledger_days(
    spark: SparkSession, path: str, since: date | None = None, before: date | None = None
) -> list[date]:
    """Days that have marks, from one listing of the ledger's folder."""
    names = _Folder(spark, path).names()
    days = [date.fromisoformat(n.removeprefix("sent_day=")) for n in names if n.startswith("sent_day=")]
    return [d for d in days if (since is None or d >= since) and (before is None or d < before)]


def _rows(spark: SparkSession, path: str, days: Iterable[_Day]) -> DataFrame:
    days = [d for d in days if d.live]
    if not days:
        return spark.createDataFrame([], _STORED)
    root = path.rstrip("/")
    folders = [f"{root}/{d.name}/part={p}" for d in days for p in d.live]
    rows = spark.read.schema(_STORED).option("basePath", root).parquet(*folders)
    gone = [
        (F.col("sent_day") == F.lit(date.fromisoformat(d.name.removeprefix("sent_day="))))
        & (F.col("part") == d.base)
        & F.col("run").isin(sorted(d.replaced))
        for d in days
        if d.base and d.replaced
    ]
    return rows.where(~reduce(lambda a, b: a | b, gone)) if gone else rows


def read_ledger(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The ledger with its day column; folders of days before ``since`` are not listed.

    A ledger without a folder is empty: nothing was sent yet.
    """
    folder = _Folder(spark, path)
    first = since.date() if since is not None else None
    rows = _rows(spark, path, [_day(folder, d) for d in ledger_days(spark, path, first)])
    if first is not None:
        rows = rows.where(F.col("sent_day") >= F.lit(first))
    return rows.select(*LEDGER_KEY, "sent_at", "sent_day")


# --------------------------------------------------------------------------- writing


def append_ledger(marks: DataFrame, path: str, run: str | int) -> None:
    """A run's marks, by day and run.

    A repeated run replaces its marks, also if it has none this time, on every day on
    which it left some; marks of other runs are not touched. Marks without a time have
    no day and fail the job.
    """
    spark, name, part = marks.sparkSession, str(run), f"{_RUN}{run}"
    if not re.fullmatch(r"[\w-]+", name):
        raise ValueError(f"not a name for a folder: {name!r}")
    day_of = F.coalesce(F.to_date("sent_at"), F.raise_error("a mark without a time").cast("date"))
    rows = marks.select(
        *LEDGER_KEY, "sent_at", F.lit(name).alias("run"), day_of.alias("sent_day"), F.lit(part).alias("part")
    )
    rows = written_once(rows, "marks")
    folder = _Folder(spark, path)
    now = {r.sent_day for r in rows.select("sent_day").distinct().collect()}
    earlier = {date.fromisoformat(n) for n in folder.names(f"_runs/{name}")}
    for d in sorted(now - earlier):  # before the marks: a run that dies is known to have been here
        folder.touch(f"_runs/{name}/{d.isoformat()}")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "sent_day", "part"
    ).parquet(path)
    for d in sorted(now | earlier):
        day = _day(folder, d)
        if part in day.covers and name not in day.replaced:
            day.replaced.add(name)
            day.covers -= {part} if d in now else set()
            _publish(folder, day)
        elif part in day.covers and d in now:
            day.covers.discard(part)
            _publish(folder, day)
        if d not in now:
            folder.remove(f"{day.name}/part={part}")
            folder.remove(f"_runs/{name}/{d.isoformat()}")
        if d in now or d in earlier:
            folder.remove(f"_closed/{d.isoformat()}")


# ------------------------------------------------------------------------ compaction


def compact_day(spark: SparkSession, path: str, day: date, keep: int | None = None) -> bool:
    """Puts the marks of a day into few files sorted by key; whether there was work.

    With ``keep`` only the newest ``keep`` marks of each kind stay (``ledger_rollover``).
    Reads give the same rows before, during and after it, but for what ``keep`` drops; the
    files it replaces stay until ``vacuum_day``, for readers that have begun. Repeating it
    changes nothing. It is for days that are over: no run may be repeating its marks of the
    day meanwhile. Of two compactions at a time the one that ends later fails.
    """
    folder = _Folder(spark, path)
    state = _day(folder, day)
    trimmed = keep is None or (state.base is not None and state.keep is not None and state.keep <= keep)
    if not state.live or not (state.loose or state.replaced) and trimmed:
        return False
    rows = _rows(spark, path, [state]).select(*LEDGER_KEY, "sent_at", "run")
    if keep is not None:
        rows = ledger_rollover(rows, keep).drop("rank")
    held = sum(folder.size(f"{state.name}/part={p}") for p in state.live)
    base = f"{_BASE}{state.version + 1}"
    rows.repartitionByRange(1 + held // FILE_BYTES, *LEDGER_KEY).sortWithinPartitions(
        *LEDGER_KEY
    ).write.mode("overwrite").parquet(f"{folder.path}/{state.name}/part={base}")
    # runs that appended in the meantime are not covered and stay loose
    state.covers |= set(state.loose)
    state.base, state.keep, state.replaced = base, keep, set()
    _publish(folder, state)
    return True


def vacuum_day(spark: SparkSession, path: str, day: date) -> None:
    """Removes the files of a day that the newest manifest replaced.

    Call it when no reader that began before the compaction is left. A run of that day
    that is repeated afterwards replaces its marks on the days it has marks for again.
    """
    folder = _Folder(spark, path)
    state = _day(folder, day)
    if not state.version:
        return
    for p in state.parts:
        if p in state.covers or (p.startswith(_BASE) and p != state.base):
            folder.remove(f"{state.name}/part={p}")
    for n in folder.names(state.name):
        old = _is_manifest(n) and n != f"{_MANIFEST}{state.version}.json"
        if old or n.endswith(".tmp"):
            folder.remove(f"{state.name}/{n}")
    for p in sorted(state.covers):
        run = p.removeprefix(_RUN)
        folder.remove(f"_runs/{run}/{day.isoformat()}")
        if not folder.names(f"_runs/{run}"):
            folder.remove(f"_runs/{run}")


def close_days(
    spark: SparkSession, path: str, as_of: datetime, keep: int = LEDGER_KEEP, days: int = LEDGER_DAYS
) -> list[date]:
    """The change of day: compacts the days that are over; which ones it worked on.

    A day that can no longer concern what a run picks (older than ``days``) keeps the
    newest ``keep`` marks per kind. Days closed for good are remembered and not listed again.
    """
    folder = _Folder(spark, path)
    closed = {date.fromisoformat(n) for n in folder.names("_closed")}
    worked = []
    for d in ledger_days(spark, path, before=as_of.date()):
        if d in closed:
            continue
        old = d < as_of.date() - timedelta(days=days)
        if compact_day(spark, path, d, keep if old else None):
            worked.append(d)
        if old:
            folder.touch(f"_closed/{d.isoformat()}")
    return worked
