"""Order-to-mart analytics for e-commerce sales, written as Spark DataFrame plans."""
