"""Landing tables, their binding to the star, and the run's table store."""
