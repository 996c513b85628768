"""Registered queries. Importing the package fills the registry."""

from . import loading, shapes, quality, domain, reports, measures, facts, refresh  # noqa: F401
