"""DataFrame operators, by subject."""
