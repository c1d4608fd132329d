"""DataFrame operators, one module per capability area."""
