"""Readers and writers of the raw, analytics and streaming layers."""
