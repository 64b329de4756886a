"""Readers for ticks, markets and metric tables."""
