"""Compositions of operators: the feature pipeline, evaluation, tuning and
experiment sweeps."""
