"""Trip statistics on Spark: landing, keyed incremental merges, streams and hot-spots."""
