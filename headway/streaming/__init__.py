"""Structured Streaming: landing of realtime feeds and incremental marts."""
