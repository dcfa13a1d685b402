"""Column rules: every function returns a Spark Column built from SQL builtins."""
