"""Table schemas, fixture derivation and the table catalog."""

from schemelens.sources.catalog import Catalog, catalog_for

__all__ = ["Catalog", "catalog_for"]
