"""Readers, writers and nested-document flatteners."""
