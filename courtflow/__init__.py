"""Play-by-play analytics as Spark DataFrame and Column functions."""
