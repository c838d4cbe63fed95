"""Plan-level helpers: shared tables, row keys, joins that survive hot keys."""
