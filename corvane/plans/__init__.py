"""Registered queries of the library's own operators, with their SQL oracles."""
