"""Column expressions. All stay on the JVM side; there is no Python UDF."""
