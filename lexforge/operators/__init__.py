"""Operators over the engine's tables."""
