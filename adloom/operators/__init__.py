"""DataFrame operators the model plans are built from."""
