"""DataFrame to DataFrame operators on fields."""
