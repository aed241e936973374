"""recsmith: customer-record batch processing expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers: Parquet registry, fixed-width / packed / delimited layouts
sinks      writers: fixed-width lines, quoted CSV, reports, generations
functions  Column-returning helpers (strings, dates, blanks, numbers, rules)
operators  DataFrame -> DataFrame operators (filters, joins, dedup, reshape)
plans      the end-to-end customer jobs built from the operators
streaming  incremental (available-now) runs of a plan over landing folders
catalog    the operator/query catalogue checked against DuckDB SQL twins
"""

from recsmith.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
