from stationflow.functions.columns import (
    DESTINATION_END_SQL,
    FILE_DIR,
    ORIGIN_END_SQL,
    complete_sql,
    file_key_sql,
    file_name_sql,
    half_even_sql,
    half_even_value_sql,
    midpoint_sql,
    month_label,
    month_label_sql,
    when_sql,
)

__all__ = [
    "DESTINATION_END_SQL",
    "FILE_DIR",
    "ORIGIN_END_SQL",
    "complete_sql",
    "file_key_sql",
    "file_name_sql",
    "half_even_sql",
    "half_even_value_sql",
    "midpoint_sql",
    "month_label",
    "month_label_sql",
    "when_sql",
]
