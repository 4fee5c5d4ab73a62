"""Column -> Column functions; all stay inside Catalyst, none is a Python UDF."""
