"""Contrastive frame sampling and training-data preparation on Spark."""
