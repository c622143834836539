"""Column-expression builders. Everything here is a built-in Spark
expression (JVM side, no Python per row)."""
