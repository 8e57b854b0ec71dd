"""Files, catalog tables, shared scratch space and the built-in region lookup."""
