"""DataFrame-to-DataFrame building blocks."""
