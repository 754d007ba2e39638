"""A PySpark engine for tagged map features, and for the tables and files around them."""
