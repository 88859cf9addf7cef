"""Readers, writers and table upkeep: message streams, lake layers, keyed tables."""
