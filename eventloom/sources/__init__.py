"""Readers, writers, declared schemas and file inventories."""
