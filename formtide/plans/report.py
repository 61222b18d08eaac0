"""Run report: one form's failure is recorded, the others go on (M7)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = "form string, status string, rows bigint, message string"


class Skipped(Exception):
    """A form that has nothing to process."""


def run_each(
    spark: SparkSession, forms: Iterable[str], job: Callable[[str], int | None], parallel: int = 4
) -> DataFrame:
    """Run a job per form and report ``form, status, rows, message``.

    A job returns its row count. Jobs of different forms are independent, so a few run at a
    time and fill the cluster together.
    """

    def attempt(form: str) -> tuple:
        try:
            return form, "done", job(form), None
        except Skipped as reason:
            return form, "skipped", 0, str(reason)
        except Exception as error:  # noqa: BLE001 - reported, not hidden
            return form, "failed", None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(attempt, forms))
    return spark.createDataFrame(rows, REPORT_SCHEMA)
