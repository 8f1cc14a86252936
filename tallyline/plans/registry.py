"""What is known of each report: its plan, which fields of a rule set to check, and how its summary is made.

All are data that a caller may add to: another report is another entry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import completeness, rollup, summary
from . import contracts as k, reports, stages

#: Report code -> plan(test data, report, ...) -> row results.
PLANS: dict[str, Callable[..., DataFrame]] = {"DS_LTX": reports.ltx, "DS_PTX": reports.ptx, "DS_FTX": reports.ftx, "DS_FTU": reports.ftu}


@dataclass(frozen=True)
class SummaryConfig:
    """How results meet test rows (by reference without its suffix first, or by test number alone), whether fee groups come along, and the output's order."""

    suffixes: tuple[str, ...] = ()
    by_reference: bool = True
    fees: bool = False
    order: tuple[str, ...] = rollup.ORDER


SUMMARIES: dict[str, SummaryConfig] = {
    "DS_LTX": SummaryConfig(("DR", "FE"), fees=True),
    "DS_FTU": SummaryConfig(),
    "DS_PTX": SummaryConfig(by_reference=False, fees=True, order=rollup.ORDER_WITH_SKIP),
    "DS_FTX": SummaryConfig(by_reference=False),
}


def register(code: str, plan: Callable[..., DataFrame], config: SummaryConfig | None = None) -> None:
    PLANS[code] = plan
    if config:
        SUMMARIES[code] = config


def selected(requested: list[str]) -> list[str]:
    """The requested reports, each once, in order; raises, naming those that are unknown or have no plan yet."""
    codes = [x.strip().upper() for x in requested if x.strip()]
    if wrong := completeness.unsupported(codes, list(PLANS)):
        raise ValueError(f"no plan for {wrong}; known without one: {[x for x in wrong if x in k.STUBS]}")
    return list(dict.fromkeys(codes))


def reconcile(code: str, test: DataFrame, report: DataFrame, **more) -> DataFrame:
    """The row results of a report's plan. more: what the plan takes beside its sheets, as its case builder (`cases`), the choice of its rules (`wanted`) and, for PTX, slots and mapping."""
    return PLANS[selected([code])[0]](test, report, **more)


def summarise(code: str, results: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(integrity counts, detail rows) of a report's results, as its configuration says; raises for a report without one."""
    if code not in SUMMARIES:
        raise ValueError(f"no summary is configured for {code}")
    config = SUMMARIES[code]
    details = stages.detail_rows(results, test, config.suffixes, config.by_reference, config.fees)
    return summary.integrity(results, details), details


def publish(code: str, results: DataFrame, test: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Hand the detail rows to write(), and count results and details while they are written: each input is read once. Returns the counts of results; raises, once all is written, if they don't make up the total or details are missing."""
    if code not in SUMMARIES:
        raise ValueError(f"no summary is configured for {code}")
    config = SUMMARIES[code]
    counted, seen = summary.observed(results)
    details, written = summary.observed(stages.detail_rows(counted, test, config.suffixes, config.by_reference, config.fees))
    write(details)
    return summary.gate(seen.get, written.get["total"])
