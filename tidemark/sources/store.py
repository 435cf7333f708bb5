"""Built tables as parquet, one directory per build, made visible by a commit.

    <root>/commits/<number>.json            one per finished build, in the order they finished
    <root>/claims/<n>                       build numbers that were ever taken
    <root>/<layer>.<table>/build=<n>        whole tables
    <root>/<layer>.<table>/build=<n>/<month column>=<month>
                                            monthly tables: the months that build n wrote
    <root>/<layer>.<snapshot>/build=<n>/state=<closed|opened|open>
                                            history: versions that build n closed, versions that
                                            it opened, and now and then all that are open

A build writes only its own directories and appends its commit last, so readers see the
whole build or nothing, a failed build leaves the tables as they were, and nothing is ever
overwritten while it is read.  A monthly build writes only the months that it touched: a
reader takes each month from the last build that wrote it.  Snapshots are a log of changes:
a reader leaves out open versions that a later build closed; every ``COMPACT_EVERY`` builds
the open versions are written whole, so the log stays short.  Closed versions are written once.

Two writers may work at once.  They never share a directory, as each takes its build number
by creating a file that must not exist yet.  The commit is such a file, too: its number is one
more than the last that the writer saw, so whoever finishes second fails with
:class:`ConcurrentBuild` and has changed nothing.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from itertools import count

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start

#: Monthly tables, and how the column that they are partitioned by makes the month.
MONTHLY: dict[str, Callable[[], Column]] = {
    "bronze.listings": lambda: month_start(F.col("source_month")),
    "silver.listings": lambda: F.col("listing_month"),
    "gold.fact_listings": lambda: F.col("listing_month"),
}
#: Builds after which the open versions of a snapshot are written whole again.
COMPACT_EVERY = 12
CLOSED, OPENED, OPEN = "closed", "opened", "open"
#: Months that a task may have open files of while it writes a monthly table.
OPEN_MONTHS = 48
#: Rows of one file of a monthly table, at most.
FILE_ROWS = 250_000
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a temporary folder, removed at exit.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


class Scratch:
    """Writes an intermediate result once, so that several consumers read it back."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._n = 0

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


class ConcurrentBuild(RuntimeError):
    """Another build was finished since this one began; nothing was changed."""


@dataclass(frozen=True)
class Commit:
    """A finished build.

    ``months`` names the months that each monthly table got, None for all of them; a table that
    is not named was not written.  ``whole`` tells that open versions were written whole,
    ``through`` the last month of the listings, ``undated`` that some have no month.
    """

    build: int
    run_ts: str
    months: Mapping[str, tuple[date | None, ...] | None]
    whole: bool = True
    through: date | None = None
    undated: bool = False

    def text(self) -> str:
        def plain(m: date | None) -> str | None:
            return m and m.isoformat()

        months = {t: ms if ms is None else [plain(m) for m in ms] for t, ms in self.months.items()}
        return json.dumps(self.__dict__ | {"months": months, "through": plain(self.through)})

    @classmethod
    def of(cls, text: str) -> Commit:
        def day(m: str | None) -> date | None:
            return m and date.fromisoformat(m)

        held = json.loads(text)
        months = {t: ms if ms is None else tuple(day(m) for m in ms) for t, ms in held["months"].items()}
        return cls(**held | {"months": months, "through": day(held["through"])})


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that Spark uses for a path, on the driver."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder, empty ones too, which Spark's readers pass over."""
    files, target = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one, which Spark's writers have no step for."""
    files, target = _file_system(spark, path)
    files.mkdirs(target.getParent())
    try:
        out = files.create(target, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def in_months(month: Column, months: Sequence[date | None]) -> Column:
    """Whether a month is one of ``months``, among which None stands for no month."""
    dated = [m for m in months if m is not None]
    found = F.coalesce(month.isin(dated), F.lit(False)) if dated else F.lit(False)
    return found | month.isNull() if None in months else found


@contextmanager
def _open_months(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, max(int(before), OPEN_MONTHS))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def write_by_month(df: DataFrame, path: str, month: str, mode: str = "errorifexists") -> None:
    """Write parquet in one directory per month, without a sort of whole rows in each task.

    A task of grouped rows meets a few months and keeps a file open for each; only rows of
    months beyond ``OPEN_MONTHS`` are sorted, by Spark.  Row keys are hashes in hexadecimal
    digits, which take half the room with zstd.
    """
    with _open_months(df.sparkSession):
        (df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS)
         .partitionBy(month).parquet(path))


class Warehouse:
    """The tables of one finished build: the last one, unless ``build`` says otherwise.

    A build never changes, so its tables are looked up once; open the folder again to see a
    later build.
    """

    def __init__(self, spark: SparkSession, root: str, build: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._last, done = self._finished()
        if build is not None:
            done = done[: [c.build for c in done].index(build) + 1 if build in [c.build for c in done] else 0]
        self.commits = done
        self.builds = [c.build for c in done]
        self._tables: dict[str, DataFrame] = {}

    # ---- commits ----

    def _finished(self) -> tuple[int, list[Commit]]:
        """The number of the last commit, and all finished builds, oldest first (one short line
        per build ever made).  A file without a line is a commit that was broken off."""
        names = _file_names(self.spark, f"{self.root}/commits")
        if not names:
            return 0, []
        log = (self.spark.read.schema("value string").text(f"{self.root}/commits")
               .select("value", F.input_file_name().alias("file")).collect())
        log = sorted((int(r.file.rsplit("/", 1)[1].partition(".")[0]), r.value) for r in log if r.value)
        return max(int(n.partition(".")[0]) for n in names), [Commit.of(v) for _, v in log]

    def next_build(self) -> int:
        return max(self.builds, default=0) + 1

    def claim(self) -> int:
        """A build number that no other writer has or had."""
        for n in count(self.next_build()):
            if put_if_absent(self.spark, f"{self.root}/claims/{n}", uuid.uuid4().hex):
                return n
        raise AssertionError

    def commit(self, build: int, run_ts: datetime, months: Mapping[str, Sequence[date | None] | None] | None = None,
               *, whole: bool = True, through: date | None = None, undated: bool = False) -> None:
        done = Commit(build, str(run_ts), dict(months or {}), whole, through, undated)
        if not put_if_absent(self.spark, f"{self.root}/commits/{self._last + 1:08d}.json", done.text()):
            raise ConcurrentBuild(f"another build of {self.root} was finished after build "
                                  f"{self.builds[-1] if self.builds else 0}; run this one again")

    # ---- tables ----

    def path(self, table: str, build: int) -> str:
        return f"{self.root}/{table}/build={build}"

    def files(self, path: str) -> list[str]:
        """Names of what lies in a folder; none if there is no folder."""
        return _file_names(self.spark, path)

    def write(self, table: str, build: int, df: DataFrame) -> DataFrame:
        """Write one table of a build and return it as read back."""
        df.write.mode("overwrite").parquet(self.path(table, build))
        return self.spark.read.schema(df.schema).parquet(self.path(table, build))

    def write_monthly(self, table: str, build: int, df: DataFrame, month: str,
                      regroup: bool) -> DataFrame:
        """Write a table in one directory per month, so that reads of a month skip the rest,
        and return it as read back.

        Rows that come month by month are written as they are.  Otherwise every task would
        write a small file into every month; ``regroup`` then shuffles months together
        first, over several tasks when a month is large.
        """
        if regroup:
            df = df.hint("rebalance", month)
        write_by_month(df, self.path(table, build), month, "overwrite")
        return self.spark.read.schema(df.schema).parquet(self.path(table, build))

    def table(self, table: str) -> DataFrame:
        if not self.builds:
            raise LookupError(f"no finished build in {self.root}")
        if table not in self._tables:
            self._tables[table] = (self.monthly(table) if table in MONTHLY else
                                   self.spark.read.parquet(self.path(table, self.builds[-1])))
        return self._tables[table]

    def month_owners(self, table: str, now: tuple[int, Sequence[date | None]] | None = None
                     ) -> tuple[int, dict[date | None, int]]:
        """The last build that wrote a monthly table whole, and the builds whose months count
        instead of its own."""
        log = [(c.build, c.months[table]) for c in self.commits if table in c.months]
        log += [now] if now else []
        whole = [i for i, (_, months) in enumerate(log) if months is None]
        if not whole:
            raise LookupError(f"no finished build in {self.root} has {table}")
        return log[whole[-1]][0], {m: b for b, months in log[whole[-1] + 1:] for m in months}

    def monthly(self, table: str, now: tuple[int, Sequence[date | None]] | None = None) -> DataFrame:
        """A monthly table, each month as the last build left it that wrote it; only directories
        that count are read.  ``now`` adds the months of a build that is not finished yet."""
        month = MONTHLY[table]()
        base, owner = self.month_owners(table, now)
        if not owner:
            return self.spark.read.parquet(self.path(table, base))
        rows = (F.col("build") == base) & ~in_months(month, list(owner))
        for b in set(owner.values()):
            rows = rows | (F.col("build") == b) & in_months(month, [m for m, o in owner.items() if o == b])
        paths = [self.path(table, b) for b in sorted({base, *owner.values()})]
        return self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths).where(rows).drop("build")

    # ---- snapshots ----

    def whole_since(self) -> int:
        """The place in ``builds`` of the last one that wrote all open versions."""
        return max((i for i, c in enumerate(self.commits) if c.whole), default=0)

    def snapshot_is_whole(self) -> bool:
        """Whether the next build should write all open versions."""
        since = [c.whole for c in reversed(self.commits)]
        return not since or True not in since or since.index(True) >= COMPACT_EVERY - 1

    def write_snapshot(self, table: str, build: int, changes: DataFrame, whole: bool = False) -> None:
        """Write the versions that a build closed, and those that it opened, or all open ones."""
        state = F.when(F.col("valid_to").isNotNull(), CLOSED).otherwise(OPEN if whole else OPENED)
        (changes.withColumn("state", state).write.mode("overwrite").partitionBy("state")
         .parquet(self.path(table, build)))

    def _versions(self, table: str, builds: list[int], whole: bool | None) -> tuple[DataFrame, DataFrame]:
        """Closed and open versions after the last of ``builds``; ``whole`` says what the last
        one wrote if it is not finished yet."""
        log = {c.build: c.whole for c in self.commits} | ({builds[-1]: whole} if whole is not None else {})
        since = max((i for i, b in enumerate(builds) if log[b]), default=0)
        held = self.spark.read.parquet(f"{self.root}/{table}")
        build, state = F.col("build"), F.col("state")
        closed = held.where((state == CLOSED) & build.isin(builds)).drop("build", "state")
        live = (state == OPEN) & (build == builds[since])
        later = builds[since + 1:]
        if not later:
            return closed, held.where(live).drop("build", "state")
        opened = held.where(live | (state == OPENED) & build.isin(later)).drop("build", "state")
        ended = held.where((state == CLOSED) & build.isin(later)).select("scd_id")
        return closed, opened.join(ended, "scd_id", "left_anti").select(*opened.columns)

    def snapshot(self, table: str, builds: list[int] | None = None, whole: bool | None = None) -> DataFrame:
        """The history after the last of ``builds``: pruned to the directories that matter."""
        closed, live = self._versions(table, builds or self.builds, whole)
        return closed.unionByName(live)

    def open_versions(self, table: str) -> DataFrame | None:
        if not self.builds:
            return None
        return self._versions(table, self.builds, None)[1]
