"""Column expressions: casts, text, time and measures. All run inside the JVM."""
