"""Trip analytics on Spark: clustering, reports, streams and a keyed table."""
