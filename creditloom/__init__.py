"""Transaction-based credit-risk analytics written as Spark DataFrame transformations."""
