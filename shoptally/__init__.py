"""shoptally: retail analytics as lazy Spark DataFrame operators."""
