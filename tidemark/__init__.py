"""tidemark: event-time, last-touch attribution on Spark."""
