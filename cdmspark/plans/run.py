"""Run a table job into its target table and report what happened (A9 + D13).

The job's rows are written in one append; the inserted count is observed on the same
pass (no second read); elapsed time is the driver clock around the write.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from ..sources.ledger import load_once, loaded_rejects, loaded_rows
from ..sources.sinks import append, create_if_absent


def load_table(spark: SparkSession, rows: DataFrame, table: str, contract: str, path: str | None = None,
               eligible: int | None = None, existing: int | None = None,
               sort_within: list[str] | None = None, rejects: DataFrame | None = None,
               load: str | None = None) -> dict:
    """Create the target if absent, append ``rows``, return the load statistics.

    ``sort_within`` (F2, e.g. person and start for observation periods) sorts each
    written file without a global sort, so file min/max statistics prune scans.

    With ``rejects`` (and ``path`` and a ``load`` id) rows and rejects are written in one job and
    committed together (``sources.ledger``); ``table`` is then a view of the committed rows, and
    running the same load again neither doubles nor loses rows."""
    if rejects is not None:
        return _load_both(spark, rows, rejects, table, contract, path, load, eligible, existing, sort_within)
    create_if_absent(spark, table, S.TABLES[contract], path=path)
    if sort_within:
        rows = rows.sortWithinPartitions(*sort_within)
    t0 = time.perf_counter()
    inserted = append(rows, table, name=f"load_{table}_{time.time_ns()}")
    elapsed = time.perf_counter() - t0
    return _stats(table, inserted, elapsed, eligible, existing)


def _load_both(spark, rows, rejects, table, contract, path, load, eligible, existing, sort_within) -> dict:
    if not path or not load:
        raise ValueError("a load with rejects needs a path and a load id")
    if sort_within:
        rows = rows.sortWithinPartitions(*sort_within)
    t0 = time.perf_counter()
    done = load_once(spark, path, load, rows, rejects)
    stats = _stats(table, done["inserted"], time.perf_counter() - t0, eligible, existing)
    loaded_rows(spark, path, S.TABLES[contract]).drop("load").createOrReplaceTempView(table)
    loaded_rejects(spark, path).createOrReplaceTempView(f"{table}_rejects")
    return stats | {"rejected": done["rejected"], "already": done["already"]}


def _stats(table: str, inserted: int, elapsed: float, eligible: int | None, existing: int | None) -> dict:
    stats = {"table": table, "inserted": inserted, "elapsed_s": round(elapsed, 3),
             "rows_per_s": round(inserted / elapsed, 1) if elapsed > 0 else None}
    if eligible is not None:
        stats["eligible"] = eligible
        stats["completion_pct"] = round(100.0 * ((existing or 0) + inserted) / eligible, 2) if eligible else None
    if existing is not None:
        stats["existing_skipped"] = existing
    return stats
