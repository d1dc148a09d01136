"""Post signals on Spark: ingest, clean, dedupe, score and aggregate social posts."""
