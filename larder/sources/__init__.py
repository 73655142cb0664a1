"""Readers, writers and the keys that tie stored files to pages."""
