"""relq: relational query operators for snapshot-style business tables, on Spark.

Packages: ``sources`` (schemas, scans, sinks, the SQL entry), ``functions``
(scalar expressions), ``operators`` (filters, projections, joins, aggregates,
ordering, checks), ``plans`` (composite reports, the registered queries and
their oracle SQL), ``llm`` (training-data operators, each with its own query).
"""
