"""Real-time half: Structured Streaming over second-by-second aggregates."""
