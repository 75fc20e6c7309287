"""Column builders: every function takes and returns Columns, none needs a UDF."""
