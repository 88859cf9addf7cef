"""Composed jobs, and the catalogue of registered queries with their SQL checks."""
