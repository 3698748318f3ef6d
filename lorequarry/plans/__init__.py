"""Importing this package registers all queries in `catalog`."""

from . import bundles, catalog, compiled, evidence, gates, governance, preflight, serving, views  # noqa: F401
