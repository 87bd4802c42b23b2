"""Full rebuild: raw tables to staging, marts, checks and reports in a warehouse."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tallyline.operators.errors import error_rows
from tallyline.operators.golden import Golden
from tallyline.operators.joins import JoinPolicy, measure_joins
from tallyline.operators.staging import stage
from tallyline.plans.quality import (
    ERROR_MART,
    ORDER_MART,
    RowCounts,
    golden_report,
    quality_report,
    table_set,
    watch_rows,
)
from tallyline.plans.reconcile import reconcile
from tallyline.plans.reports import error_details, error_type_summary
from tallyline.schemas import Inputs
from tallyline.session import finer_tasks
from tallyline.sources.warehouse import CatalogWarehouse, FolderWarehouse

Warehouse = FolderWarehouse | CatalogWarehouse


@dataclass(frozen=True)
class Marts:
    staged: Inputs
    orders: DataFrame
    errors: DataFrame
    watched: RowCounts = field(default_factory=dict)  # failing rows, counted while they were written

    def tables(self) -> dict[str, DataFrame]:
        return table_set(self.staged, self.orders, self.errors)


def _write(warehouse: Warehouse, layer: str, name: str, table: DataFrame, watched: RowCounts) -> DataFrame:
    """Write a table, and count the rows that fail its checks on the way."""
    table, told = watch_rows(name, table)
    stored = warehouse.write(layer, name, table)
    watched.update(told())
    return stored


def _write_all(warehouse: Warehouse, layer: str, tables: dict[str, DataFrame], watched: RowCounts) -> list[DataFrame]:
    """Independent tables are written side by side, so that none waits for another's last task.

    A layer that the run has finished before it broke off is read instead.
    """
    if warehouse.finished(layer):
        return [warehouse.read_version(layer, name, warehouse.version) for name in tables]
    with ThreadPoolExecutor(len(tables)) as pool:
        stored = list(pool.map(lambda item: _write(warehouse, layer, *item, watched), tables.items()))
    warehouse.mark(layer)
    return stored


def load_raw(warehouse: Warehouse, raw: Inputs) -> Inputs:
    """Keep the raw tables as they came."""
    return Inputs(*_write_all(warehouse, "raw", dict(raw.items()), {}))


def build_marts(warehouse: Warehouse, raw: Inputs, policy: JoinPolicy = JoinPolicy()) -> Marts:
    """Each layer is stored and read back: joins, checks and reports scan columns, not CSV text,
    and the three joins of the order mart run once however many readers it has."""
    watched: RowCounts = {}
    staged = Inputs(*_write_all(warehouse, "staging", stage(raw).tables(), watched))
    if warehouse.finished("marts"):
        done = [warehouse.read_version("marts", name, warehouse.version) for name in (ORDER_MART, ERROR_MART)]
        return Marts(staged, *done, watched)
    mart = reconcile(staged, measure_joins(staged, policy))
    with finer_tasks(warehouse.spark):
        orders = _write(warehouse, "marts", ORDER_MART, mart, watched)
        errors = _write(warehouse, "marts", ERROR_MART, error_rows(orders), watched)
    warehouse.mark("marts")
    return Marts(staged, orders, errors, watched)


def check_marts(warehouse: Warehouse, marts: Marts, golden: Golden | None = None) -> DataFrame:
    """All checks, and the comparison with expected results if there are any."""
    report = quality_report(marts.tables(), watched=marts.watched)
    if golden:
        report = report.unionByName(golden_report(marts.orders, marts.errors, golden))
    return warehouse.write("checks", "quality_report", report)


def write_reports(warehouse: Warehouse, marts: Marts, unique: bool = False) -> None:
    """Both reports; `unique` says that the checks found every order once and with an id."""
    warehouse.write("reports", "error_type_summary", error_type_summary(marts.errors))
    details = error_details(marts.errors, marts.orders, unique)
    warehouse.write("reports", "error_details", details)
