"""Operators for training-data pipelines: filtering, de-duplication, scanning, extraction and token output."""
