"""Web-intelligence analytics as Spark jobs."""
