"""Marketing analytics on Spark: raw ad exports in, one typed fact table per brand out."""
