"""Column expressions used by the operators. All of them stay in the JVM."""
