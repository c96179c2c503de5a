"""Training-data operators: filtering, dedup, mixing, tokenization and web archives on Spark.

Nothing else in the library imports this package."""
