"""Operators wired to whole analyses, the registered queries and their SQL."""
