"""Column-to-Column expressions. Everything here is narrow and stays inside the JVM."""
