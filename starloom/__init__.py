"""Star-schema analytics as Spark jobs: conform, publish, check and measure."""
