"""Column functions: business rules and date arithmetic."""
