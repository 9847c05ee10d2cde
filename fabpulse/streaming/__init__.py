"""Structured Streaming: landing of messages, capture of anomalies."""
