"""Size checks, ordered chunks and the queries over the given tables."""
