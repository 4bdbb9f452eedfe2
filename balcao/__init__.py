"""balcao: store-sales analytics written as Spark DataFrame plans."""
