"""The incremental jobs as Structured Streaming queries over the same operators."""
