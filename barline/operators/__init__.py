"""Lazy operators over bars, features, scores and labels."""
