"""Files to traceable per-record events, and the operations a training-data pipeline needs, on Spark."""
