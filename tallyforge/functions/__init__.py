"""Column functions; all of them build JVM-side expressions."""
