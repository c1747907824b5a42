"""Column expressions: JVM-side building blocks used by the operators."""
