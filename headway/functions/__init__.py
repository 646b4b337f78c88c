"""Column expressions: dates and zones, schedule times, delay buckets."""
