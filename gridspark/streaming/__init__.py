"""Structured Streaming operators (readers live in ``sources.landing``)."""
