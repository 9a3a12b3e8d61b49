"""civicstat: regional-indicator analytics and data-quality checks on Spark.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame built from native Spark expressions, so Catalyst plans the whole
job and nothing is collected on the driver until the caller acts.

Sub-packages
------------
sources    -- table loading, catalog views/listing, expected-value relations
functions  -- Column-level helpers (labels, lenient numbers, tolerance rules)
operators  -- star joins, long-table selection, reshaping, ranking,
              quality checks, profiles and gap rules
plans      -- the registered queries over the driver tables (and the derived
              long indicator table) with their SQL oracles
streaming  -- running the same checks over a Structured Streaming source
"""

from civicstat.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
