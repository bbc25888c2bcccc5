"""Operators of a training-data pipeline: text cleaning, deduplication, scoring, packing and archives."""
