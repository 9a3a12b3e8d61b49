"""Sources: table access, catalog operations, expected-value relations."""

from civicstat.sources.tables import Tables, load, DRIVER_TABLES
