"""Play-by-play analytics written as Spark DataFrame transformations."""
