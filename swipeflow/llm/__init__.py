"""Operators of a training-data pipeline: text in, decisions, spans, fingerprints and token ids out."""
