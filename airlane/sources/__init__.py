"""Readers and writers: snapshots, message log, stored tables, archives."""
