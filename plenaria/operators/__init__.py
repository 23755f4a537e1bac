"""DataFrame operators: versions, joins, intervals, aggregates, keys, merges and checks."""
