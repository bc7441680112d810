"""Transaction quality checks, duplicate flags and daily summaries on Spark."""
