"""Readers, landing and the typed base layer."""
