"""Readers, writers and ledgers."""
