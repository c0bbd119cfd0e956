"""Queries and whole jobs; importing the package registers every query in `queries`."""

from . import files, records, texts  # noqa: F401
