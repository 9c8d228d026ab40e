"""DataFrame operators: cleaning, joins, windows, statistics, sampling, drift."""
