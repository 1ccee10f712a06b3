"""Column expressions built only from Spark built-ins (JVM side, codegen)."""
