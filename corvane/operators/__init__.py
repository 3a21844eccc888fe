"""DataFrame operators of the library."""
