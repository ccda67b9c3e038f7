"""Registered queries: every operator run over the driver's tables, with the SQL that checks it."""

from bibspark.plans.registry import QUERIES, Tables, query  # noqa: F401
from bibspark.plans import derived, filters, grouped, joined, listed, load, ordered, searching, streamed, vectored  # noqa: F401, E402
