"""Column -> Column building blocks; all run inside the JVM."""
