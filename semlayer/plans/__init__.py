"""From a view of a source to a lazy DataFrame."""
