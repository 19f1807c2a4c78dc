"""Readers, writers and fixed reference rows."""
