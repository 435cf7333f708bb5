"""Whole jobs: the build, the marts and the data-quality suite."""
