"""Registered queries over the driver tables and the derived long table IND.

Modules
-------
indicators        IND, the long indicator table derived by Spark from orders,
                  customer, lineitem, supplier, nation and region (two plans,
                  identical rows), and ``IND_SQL``, its DuckDB twin
registry          ``@query(name, sql=..., ids=...)``: a Spark builder
                  ``fn(spark, sf_dir) -> DataFrame`` plus its oracle SQL
star_queries      star-schema shapes (enrichment, predicates, coverage union)
longform_queries  section views and LIKE / IN / fallback selections on IND
reshape_queries   pivots, unpivot, stack offsets, ordered and mean series
rank_queries      latest per group / global, top-k, median flag, typed sort
label_queries     CASE/split labels, literal strips, label maps, number text
quality_queries   the validator's check categories on the driver tables
profile_queries   section / characteristic / completeness profiles, coverage
gap_queries       gap and freshness rules and the issue register
dashboards        the twenty star-schema dashboard queries (library functions)
indicator_report  the notebook's analyses over any long table (library functions)
star_layout       the reference layout: validation spec, views, retirement

Adding a query: write the builder with operators from ``civicstat.operators``,
decorate it with ``@query`` and the equivalent DuckDB SQL (prefix IND-based
SQL with ``with_ind``), alias every computed column identically on both
sides, and run ``tools/oracle_check.py``.
"""
