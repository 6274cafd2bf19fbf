"""Column-expression functions (JVM-side, codegen-friendly, no Python UDFs)."""
