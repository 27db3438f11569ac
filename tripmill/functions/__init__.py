"""Column-valued building blocks; nothing here runs a job or leaves the JVM."""
