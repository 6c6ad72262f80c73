"""Analytics on self-describing observation records, on Spark."""
