"""Readers, writers and text-log parsers."""
