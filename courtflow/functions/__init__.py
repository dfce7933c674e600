"""Column functions: seasons, periods, casts, JSON paths, HTML scripts."""
