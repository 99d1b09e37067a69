"""Readers, writers and the adapters that turn trade tables into bars."""
