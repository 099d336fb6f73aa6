"""Column expressions; every one runs on the JVM."""
