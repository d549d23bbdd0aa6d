"""moraflow: debt-collection analytics as Spark DataFrame operators."""
