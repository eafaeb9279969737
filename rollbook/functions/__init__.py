"""Column functions. Everything here is a JVM-side expression."""
