"""DataFrame -> DataFrame operators: ordered frames, joins, upserts, checks, metrics, matching."""
