"""Column helpers, chunked scans and distributed order statistics."""
