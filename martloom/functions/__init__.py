"""Column expressions shared by the operators; every one stays inside the JVM."""
