"""Column expressions: JVM-side building blocks shared by the operators."""
