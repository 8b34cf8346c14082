"""Ledgers and streams."""
