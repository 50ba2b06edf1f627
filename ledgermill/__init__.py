"""Retail-finance analytics on Spark: ingest, staging, marts, CDC, governance, quality, streaming."""
