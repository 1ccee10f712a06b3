"""Import every query module so that the registry is complete."""

from . import queries_facts, queries_ingest, queries_models, queries_present, queries_series  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
