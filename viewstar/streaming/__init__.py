"""Structured Streaming: message ingest with watermark dedup, the batch
monitor, and the exactly-once warehouse loader."""
