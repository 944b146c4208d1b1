"""DataFrame-to-DataFrame operators: filters, projections, joins, aggregates, ordering, checks."""
