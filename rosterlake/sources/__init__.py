"""Readers of landed files and writers of results. Fetching is left to whoever lands the files."""
