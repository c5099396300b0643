"""Column helpers. All of them return plain Catalyst expressions."""
