"""Clocks, sinks and a runner for Structured Streaming."""
