"""Power and sensor telemetry analytics for vehicle fleets, as Spark jobs."""
