"""Box-score feature building on Spark: pages and sheets in, model-ready rows out."""
