"""Readers and writers for bars, scores, features, lists and models."""
