"""The models: one function per model, streams in, DataFrame out."""
