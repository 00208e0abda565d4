"""Expressions shared by the operators.

Each is written once as Spark SQL text (``*_sql``). Operators build their
projections and aggregates from the SQL text with
``selectExpr``/``expr``: the plan is the same as with Column objects, but a
whole expression crosses from Python to the JVM in one call instead of one
call per node. All are built-in expressions and stay in whole-stage code
generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schema import MONTH_LABEL_LENGTH, ROLE, ROLE_DESTINATION, ROLE_ORIGIN

# --- SQL text -------------------------------------------------------------------


def half_even_sql(expr: str) -> str:
    """Round to the nearest integer, ties to the even neighbour (2.5 -> 2,
    3.5 -> 4), as BIGINT. ``round`` would round ties away from zero."""
    return f"CAST(bround({expr}, 0) AS BIGINT)"


def half_even_value_sql(expr: str) -> str:
    """Half-even rounding that keeps the input type (BIGINT stays BIGINT,
    DOUBLE stays DOUBLE)."""
    return f"bround({expr}, 0)"


def midpoint_sql(a: str, b: str) -> str:
    """Unweighted mean of two values, true division, DOUBLE."""
    return f"(({a}) + ({b})) / 2.0D"


def month_label_sql(file_name: str) -> str:
    """First six characters of a file name (``201801_usage.json`` -> ``201801``)."""
    return f"substring({file_name}, 1, {MONTH_LABEL_LENGTH})"


ORIGIN_END_SQL = f"{ROLE} = '{ROLE_ORIGIN}'"
DESTINATION_END_SQL = f"{ROLE} = '{ROLE_DESTINATION}'"


def when_sql(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} END"


# --- the file a row belongs to ------------------------------------------------

# Name of the partition directories that hold a file stored in parts.
FILE_DIR = "file="


def file_key_sql(path: str = "_metadata.file_path") -> str:
    """Identity of the file a row was read from: its decoded path, or the
    decoded path of the ``file=<name>`` directory that holds its parts.

    ``_metadata`` paths come URL-encoded (a space shows as ``%20``).
    ``url_decode`` would also turn a literal ``+`` into a space, so ``+`` is
    protected as ``%2B`` first; paths without any escape are kept as they
    are. Directory names are escaped once more by the partition writer.

    The expression runs once per trip, so the directory is found by string
    functions from the path's end, without a regular expression."""
    def decoded(x: str) -> str:
        return f"CASE WHEN contains({x}, '%') THEN url_decode(replace({x}, '+', '%2B')) ELSE {x} END"

    steps = f"substring_index({path}, '/', -2)"
    in_parts = f"startswith({steps}, '{FILE_DIR}') AND NOT startswith({steps}, '{FILE_DIR}/')"
    whole = f"substring({path}, 1, length({path}) - length(substring_index({path}, '/', -1)) - 1)"
    return f"CASE WHEN {in_parts} THEN {decoded(f'({decoded(whole)})')} ELSE {decoded(path)} END"


def file_name_sql(file: str) -> str:
    """Label of a file: the last step of its identity."""
    step = f"substring_index({file}, '/', -1)"
    return f"CASE WHEN startswith({step}, '{FILE_DIR}') THEN substring({step}, {len(FILE_DIR) + 1}) ELSE {step} END"


def month_label(file_name: Column | str) -> Column:
    """First six characters of a file name, as a Column."""
    col = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.substring(col, 1, MONTH_LABEL_LENGTH)


def complete_sql(fields: list[str]) -> str:
    """A condition that holds for a record with every field and fails the
    task otherwise. As a filter it is never pruned, whichever fields the
    query uses."""
    tests = " ".join(f"WHEN `{f}` IS NULL THEN raise_error('trip record lacks field {f}')" for f in fields)
    return f"CASE {tests} ELSE true END"
