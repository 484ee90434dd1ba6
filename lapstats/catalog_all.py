"""Import every query module so that ``catalog.QUERIES`` is complete."""

from . import catalog, catalog_exprs, catalog_plans, catalog_sources  # noqa: F401
