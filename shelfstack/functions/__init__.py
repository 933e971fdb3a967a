"""Column expressions: text clean-up, typed values, masking, nested fields."""
