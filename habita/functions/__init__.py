"""Column expressions (JVM-side, codegen-friendly) used by the operators."""
