"""Whole jobs put together from the operators, sources and sinks."""
