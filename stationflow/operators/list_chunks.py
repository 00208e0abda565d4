"""Connection lists as ordered arrays of bounded length.

A list (file, station, role) is ordered by other station and travel time (NULLs
first) and cut into chunks of at most ``size`` elements. No list is gathered: all
elements are sorted together into range partitions, whatever list they belong to,
and an element's place in its list is the number of the list's elements in the
partitions before (a sum over one row per list and partition) plus its place in its
own partition. So a list that holds a third of all trips is spread over a third of
the tasks, and an array never has more than ``size`` elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.operators.stations import MULTIPLICITY, _labelled
from stationflow.schema import FILE, OTHER_STATION, ROLE, STATION, TRAVEL_TIME
from stationflow.sources.files import new_shared_folder

CHUNK = "chunk"
ELEMENTS = "elements"
LIST = (FILE, STATION, ROLE)
_PART = "_part"


def placed_elements(lists: DataFrame, partitions: int | None = None) -> DataFrame:
    """Elements of connection lists in range partitions by list, other station and
    travel time, with the partition's number; stored, so that both stay."""
    order = [*LIST, OTHER_STATION, TRAVEL_TIME]
    rows = lists.select(*order, MULTIPLICITY)
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    path = new_shared_folder(lists.sparkSession, "list-elements")
    ranged.withColumn(_PART, F.spark_partition_id()).write.parquet(path)
    return lists.sparkSession.read.parquet(path)


def numbered_elements(placed: DataFrame) -> DataFrame:
    """Elements with the ordinals ``first`` (from 0) to ``last`` (exclusive) that
    their multiplicity takes in their list."""
    keys = ", ".join(LIST)
    counts = placed.groupBy(*LIST, _PART).agg(F.expr(f"sum({MULTIPLICITY}) AS _c"))
    before = f"sum(_c) OVER (PARTITION BY {keys} ORDER BY {_PART} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = counts.selectExpr(*[f"{c} AS _o{c}" for c in (*LIST, _PART)], f"coalesce({before}, 0) AS _before")
    # One list within one partition: bounded by the partition.
    upto = f"sum({MULTIPLICITY}) OVER (PARTITION BY {keys}, {_PART} ORDER BY {OTHER_STATION}, {TRAVEL_TIME} ROWS UNBOUNDED PRECEDING)"
    own = placed.selectExpr("*", f"{upto} AS _upto")
    same = " AND ".join(f"{c} <=> _o{c}" for c in (*LIST, _PART))
    joined = own.join(offsets, F.expr(same))
    return joined.selectExpr(
        *LIST, OTHER_STATION, TRAVEL_TIME, f"_before + _upto - {MULTIPLICITY} AS first", "_before + _upto AS last"
    )


def connection_list_chunks(lists: DataFrame, *, size: int = 1000, partitions: int | None = None) -> DataFrame:
    """The lists of :func:`connection_lists` as rows
    ``file, file_name, month, station, role, chunk, elements``: chunk 0, 1, ... of a
    list in order, each an array of (other_station, travel_time) with ``size``
    elements, the last one with what is left."""
    if size < 1:
        raise ValueError("size must be at least 1")
    spans = numbered_elements(placed_elements(lists, partitions)).selectExpr(
        "*", f"explode(sequence(first DIV {size}, (last - 1) DIV {size})) AS {CHUNK}"
    )
    times = f"CAST(least(last, ({CHUNK} + 1) * {size}) - greatest(first, {CHUNK} * {size}) AS INT)"
    cut = spans.selectExpr(*LIST, CHUNK, f"struct({OTHER_STATION}, {TRAVEL_TIME}, {times} AS times) AS e")
    one = f"struct(e.{OTHER_STATION} AS {OTHER_STATION}, e.{TRAVEL_TIME} AS {TRAVEL_TIME})"
    gathered = f"flatten(transform(sort_array(collect_list(e)), e -> array_repeat({one}, e.times))) AS {ELEMENTS}"
    chunks = cut.groupBy(*LIST, CHUNK).agg(F.expr(gathered))
    return _labelled(chunks, STATION, ROLE, CHUNK, ELEMENTS)
