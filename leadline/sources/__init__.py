"""Readers: growing logs, state documents, table snapshots and stored tables."""
