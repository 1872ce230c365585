"""Reading raw extracts and stage tables, and writing them back."""
