"""Column expressions. Everything here is built-in Spark and stays in the JVM."""
