"""DataFrame operators: keys, expectations, joins, aggregates, top-k."""
