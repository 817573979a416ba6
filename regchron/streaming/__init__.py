"""File-once bulk loading."""
