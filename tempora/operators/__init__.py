"""DataFrame -> DataFrame operators (projections, aggregates, joins, windows, views, profiles, ML)."""
