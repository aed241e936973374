"""Importing this package registers every catalogue query."""

from recsmith.catalog.registry import COVERS, QUERIES, SQL  # noqa: F401
from recsmith.catalog import columns, files, io, joins, jobs, lookups, rows  # noqa: F401
