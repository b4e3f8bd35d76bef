"""Reading and writing layers."""
