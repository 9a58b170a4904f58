"""The Structured Streaming job."""
