"""Trip and ride analytics as Spark DataFrame transformations."""
