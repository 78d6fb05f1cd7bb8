"""Column functions over LaTeX source; all run inside the JVM."""
