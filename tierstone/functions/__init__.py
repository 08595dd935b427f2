"""Column expressions of the shop domain, all evaluated inside the JVM."""
