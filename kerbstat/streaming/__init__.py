"""Structured Streaming: windows, scoring, alerts, sinks and replay."""
