"""Independent SQL statements of what each query returns."""
