"""Training, tuning, scoring and multi-experiment runs built from the operators."""
