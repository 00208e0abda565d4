"""Training-data operators on Spark: mixing, dedup, filters, scoring, scans.

Each module holds one operator with its own interface; :mod:`queries`
registers one query per operator. Nothing else in the library imports this
subpackage."""
