"""Column expressions (native Spark, whole-stage codegen friendly)."""
