"""Readers, writers and the derived transaction table."""
