"""Column-expression helpers and the model's classification columns."""
