"""Filing-facts analytics expressed as Spark DataFrame transformations."""
