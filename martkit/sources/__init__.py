"""Readers, writers and stateful loads."""
