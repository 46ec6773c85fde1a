"""Column-in, Column-out helpers; every one stays inside JVM code generation."""
