"""Readers, sinks and the adapters from star-schema tables to the trip contracts."""
