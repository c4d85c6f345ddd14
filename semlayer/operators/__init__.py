"""Table-level operators: materialisation, data-quality checks, key checks, closure."""
