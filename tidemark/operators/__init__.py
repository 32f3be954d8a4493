"""DataFrame operators: shaping, loading, joins, aggregates, windows, history, checks."""
