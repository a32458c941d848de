"""Whole jobs (validate, prepare, train, score) and the registered queries."""
