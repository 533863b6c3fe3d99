"""Request-latency analytics as lazy Spark DataFrame operators."""
