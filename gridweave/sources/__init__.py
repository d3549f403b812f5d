"""Reading and writing stored fields, weights and attributes."""
