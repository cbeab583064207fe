"""Bindings of the operators onto tables."""
