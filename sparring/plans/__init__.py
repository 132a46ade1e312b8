"""Whole runs: the model registry and the experiment."""
