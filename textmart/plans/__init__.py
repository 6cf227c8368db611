"""Whole runs: collect ids, extract entries, analyse the model."""
