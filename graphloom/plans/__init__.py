"""Whole runs (construct, append, export, compare) and the registered queries."""
