"""Column-level helpers; all of them are Spark built-ins put together, none is a UDF."""
