"""Column-expression helpers: names, dates, numbers, measures."""
