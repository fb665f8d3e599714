"""Readers and writers for tables, files, queues and databases."""
