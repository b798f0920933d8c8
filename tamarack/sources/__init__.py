"""Readers, parsers, generators and writers."""
