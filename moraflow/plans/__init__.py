"""Facts, reports and quality checks composed from the operators."""
