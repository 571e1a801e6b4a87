"""Column functions: everything here maps Columns to Columns."""
