"""Views over views: refreshed in the order of their inputs, and only where an input has a new version."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ..contract import END_AT, START_AT, Contract
from ..errors import ContractError, require
from ..functions.relations import require_declared
from ..operators.projection import current_rows
from ..sources.datasets import Dataset
from .views import materialize, python_view, sql_view

CURRENT, HISTORY = "current", "history"


@dataclass(frozen=True)
class Input:
    """A dataset folder that this engine writes, or a catalog table, as a view reads it."""

    location: str
    port: str = CURRENT

    def __post_init__(self):
        require(self.port in (CURRENT, HISTORY), "An input is read by its current or its history port")

    @property
    def table(self) -> bool:
        return "/" not in self.location

    def read(self, spark: SparkSession) -> tuple[DataFrame, int | None]:
        """Its rows, and the version that they are of. A catalog table has no version of ours; its history port is the table that
        holds closed rows too, and its current port, where it keeps history, only the open ones."""
        if not self.table:
            return Dataset(spark, self.location).read_pinned(self.port)
        rows = spark.table(self.location)
        if self.port == HISTORY:
            require(END_AT in rows.columns, "The catalog table keeps no history")
            return rows, None
        return (current_rows(rows).drop(START_AT, END_AT) if END_AT in rows.columns else rows), None


@dataclass(frozen=True)
class View:
    """A typed result of SQL text, or of a Python function, over named inputs. An input's name may be that of another view."""

    name: str
    query: str | Callable[[dict[str, DataFrame]], DataFrame]
    contract: Contract
    target: str
    inputs: Mapping[str, Input] = field(default_factory=dict)
    views: Sequence[str] = ()
    unsupported: str = "error"
    results: str | None = None


@dataclass(frozen=True)
class ViewGraph:
    views: Sequence[View]

    def __post_init__(self):
        names = [v.name for v in self.views]
        require(len(set(names)) == len(names) and len({v.target for v in self.views}) == len(names), "Views have names and targets of their own")
        for view in self.views:
            unknown = sorted(set(view.views) - set(names))
            require(not unknown, f"{view.name} reads views that are not declared: {', '.join(unknown)}")
            require(not set(view.views) & set(view.inputs), f"{view.name} has two inputs of one name")
        self.order()

    def order(self) -> list[View]:
        """Every view after those that it reads; among equals as declared."""
        by_name = {v.name: v for v in self.views}
        try:
            return [by_name[n] for n in TopologicalSorter({v.name: list(v.views) for v in self.views}).static_order()]
        except CycleError as error:
            raise ContractError(f"Views read each other: {' -> '.join(error.args[1])}") from None

    def refresh(self, spark: SparkSession) -> list[str]:
        """Bring all views up to date in one run; the names of those that were built again.

        Each version of a view names the versions of its inputs. Where none moved, the view stays; a catalog table may always have
        moved. A failing view stops the run; those before it are committed and will not be built again.
        """
        by_name, built = {v.name: v for v in self.views}, []
        for view in self.order():
            if isinstance(view.query, str):
                require_declared(spark, view.query.strip().rstrip(";"), [*view.inputs, *view.views])
            sources = {**view.inputs, **{n: Input(by_name[n].target) for n in view.views}}
            pinned = {n: source.read(spark) for n, source in sources.items()}
            versions = {n: number for n, (_, number) in pinned.items()}
            last = Dataset(spark, view.target).version()
            if last and None not in versions.values() and last.info.get("inputs") == versions:
                continue
            frames = {n: frame for n, (frame, _) in pinned.items()}
            made = sql_view(spark, view.query, frames, view.contract) if isinstance(view.query, str) else python_view(view.query, frames, view.contract)
            materialize(spark, made, view.target, view.contract, view.unsupported, view.results, {"inputs": versions})
            built.append(view.name)
        return built
