"""Importing this module fills the registry."""

from lateline.registry import dashboard, features, messages, parts, profiles, sources, tables  # noqa: F401
from lateline.registry.catalogue import QUERIES, queries_with_sql  # noqa: F401
