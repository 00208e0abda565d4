"""Rankings: top k stations per file, and top k overall.

Ties on the score are broken by ascending station id so that the cut at
the k-th place is deterministic. ``score`` is a Spark SQL expression over
the columns of the ranked table (for example ``connections``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.schema import FILE, RANK, STATION


def _order_sql(score: str) -> str:
    return f"({score}) DESC NULLS LAST, {STATION} ASC NULLS FIRST"


def top_k_per_file(df: DataFrame, score: str, k: int, *, by: str = FILE) -> DataFrame:
    """The ``k`` best stations of every file, with their ``rank`` (1..k).

    A row-number window per file filtered on ``rank <= k``; Spark plans it
    with a group limit before and after the shuffle, so each file moves at
    most k rows per task. ``df`` has one row per (file, station), so a
    window partition is bounded by the number of stations."""
    ranked = df.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {by} ORDER BY {_order_sql(score)}) AS {RANK}"
    )
    return ranked.where(f"{RANK} <= {int(k)}")


def top_k(df: DataFrame, score: str, k: int) -> DataFrame:
    """The ``k`` best rows overall, in rank order (a single top-k, no full
    sort)."""
    return df.orderBy(F.expr(score).desc_nulls_last(), F.col(STATION).asc_nulls_first()).limit(int(k))
