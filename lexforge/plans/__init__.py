"""Whole jobs: refresh, ranking, report, command line."""
