"""DataFrame -> DataFrame operators (dedup, curation, aggregates, windows, joins, rules)."""
