"""Copy, clean and reconcile relational tables with Spark DataFrames."""
