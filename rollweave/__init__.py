"""Resolution of ordered, noisy page records into per-entity packets, on Spark."""
