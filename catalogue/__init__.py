"""A model over the supplied tables, and one registered query per operator."""
