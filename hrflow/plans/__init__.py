"""Dimensions, facts, marts, metrics and reports."""
