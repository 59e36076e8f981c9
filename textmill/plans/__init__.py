"""Whole runs: from raw splits to model rows, and from model rows to scores."""
