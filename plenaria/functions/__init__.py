"""Column-in, column-out functions; all stay inside the JVM."""
