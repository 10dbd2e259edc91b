"""Readers, loads and exports."""
