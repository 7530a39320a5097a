"""Readers, writers and rule packs."""
