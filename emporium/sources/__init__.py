"""Sources: logical tables over the test data, CSV, JDBC, metrics text and JSON."""

from emporium.sources.testdata import Star

__all__ = ["Star"]
