"""Lasting views over a build, for other sessions and tools on the same catalog.

A view names the directories of one build, which never change, so what it shows is that build
until the next one is published.  Marts are stored with the build when they are published, so
reading one does not compute it again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..sources.store import CLOSED, MONTHLY, OPEN, OPENED, Warehouse
from .build import CENSUS, MARTS, SNAPSHOTS, TABLES, mart, table

# The month of a row, by the column that the table is partitioned by.
_MONTH = {name: "listing_month" for name in MONTHLY} | {
    "bronze.listings": "CASE WHEN size(split(source_month, '_')) = 2 THEN try_cast(concat_ws('-', "
                       "substring_index(source_month, '_', -1), substring_index(source_month, '_', 1), '01') AS date) END"}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _in_months(month: str, months: Sequence[date | None]) -> str:
    dated = ", ".join(f"DATE'{m}'" for m in months if m is not None)
    tests = [f"coalesce({month} IN ({dated}), false)"] if dated else []
    if None in months:
        tests.append(f"({month}) IS NULL")
    return "(" + " OR ".join(tests or ["false"]) + ")"


def _files(house: Warehouse, name: str, build: int) -> str:
    return f"parquet.{_quoted(house.path(name, build))}"


def _select(columns: Iterable[str], source: str, where: str | None = None) -> str:
    return f"SELECT {', '.join(map(_quoted, columns))} FROM {source}" + (f" WHERE {where}" if where else "")


def _union(parts: Sequence[str], shape: T.StructType) -> str:
    """Nothing written means no rows, of the columns that the table has."""
    empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in shape)
    return " UNION ALL ".join(parts) if parts else f"SELECT {empty} WHERE false"


def _monthly_sql(house: Warehouse, name: str, shape: T.StructType) -> str:
    base, owner = house.month_owners(name)
    month = _MONTH[name]
    wanted = {b: _in_months(month, [m for m, o in owner.items() if o == b]) for b in sorted(set(owner.values()))}
    wanted = {base: f"NOT {_in_months(month, list(owner))}" if owner else None} | wanted
    return _union([_select(shape.names, _files(house, name, b), w) for b, w in wanted.items()
                   if any("=" in f for f in house.files(house.path(name, b)))], shape)


def _snapshot_sql(house: Warehouse, name: str, shape: T.StructType) -> str:
    builds, since = house.builds, house.whole_since()

    def parts(state: str, among: Sequence[int], columns: Sequence[str]) -> list[str]:
        return [_select(columns, f"parquet.{_quoted(house.path(name, b))[:-1]}/state={state}`")
                for b in among if f"state={state}" in house.files(house.path(name, b))]

    live = parts(OPEN, builds[since: since + 1], shape.names) + parts(OPENED, builds[since + 1:], shape.names)
    now = f"SELECT * FROM ({_union(live, shape)}) AS live"
    if ended := parts(CLOSED, builds[since + 1:], ["scd_id"]):
        now += f" WHERE NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(ended)}) AS ended WHERE ended.scd_id = live.scd_id)"
    return " UNION ALL ".join([*parts(CLOSED, builds, shape.names), now])


def stored_mart(house: Warehouse, name: str) -> DataFrame:
    """A mart as rows stored with the build; made the first time."""
    path = house.path(f"mart.{name}", house.builds[-1])
    if "_SUCCESS" not in house.files(path):
        mart(house, name).write.mode("overwrite").parquet(path)
    return house.spark.read.parquet(path)


def view_sql(house: Warehouse, name: str) -> str:
    """The query of a view of one table, snapshot or mart of a build."""
    layer, _, alias = name.partition(".")
    if layer == "gold" and alias in CENSUS:
        name = f"silver.{alias}"
    shape = (stored_mart(house, alias) if layer == "mart" else table(house, name)).schema
    if name in SNAPSHOTS:
        return _snapshot_sql(house, name, shape)
    if name in MONTHLY:
        return _monthly_sql(house, name, shape)
    return _select(shape.names, _files(house, name, house.builds[-1]))


def publish(house: Warehouse, database: str, prefix: str = "") -> list[str]:
    """Create or replace ``<database>.<prefix><layer>_<alias>`` for everything built.

    All queries are made, and the marts stored, before the first view is replaced; each view is
    then swapped in one step.  To go back, publish an earlier build.
    """
    spark = house.spark
    names = [*TABLES, *SNAPSHOTS, *(f"gold.{c}" for c in CENSUS), *MARTS]
    texts = {f"{_quoted(database)}.{_quoted(prefix + n.replace('.', '_'))}": view_sql(house, n) for n in names}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    for view, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
    return [prefix + n.replace(".", "_") for n in names]
