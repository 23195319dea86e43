"""Readers and sinks: archives, catalog / series JSON, typed CSV evidence, landing."""
