"""Column expressions used by the operators; all stay inside the JVM."""
