"""Supervised learning on Spark tables: ingestion, preparation, training, scoring, evaluation, run logs."""
