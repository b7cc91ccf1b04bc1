"""DataFrame in, DataFrame out: one module per group of operators."""
