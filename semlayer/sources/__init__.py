"""Sources of a model and readers for the tables and files they stand on."""
