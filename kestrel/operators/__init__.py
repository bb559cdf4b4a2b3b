"""DataFrame -> DataFrame operators (projections, joins, aggregates, windows, splits, ...)."""
