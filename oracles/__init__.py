"""Independent SQL for every registered query, in the dialect of the checking engine."""
