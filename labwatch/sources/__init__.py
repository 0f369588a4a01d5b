"""Readers of laboratory files."""
