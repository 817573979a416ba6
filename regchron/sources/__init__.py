"""Readers of registry extracts and business records; the bronze log and the history table."""
