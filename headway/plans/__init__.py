"""Plans: end-to-end builds, sinks and publishing, the query registry."""
