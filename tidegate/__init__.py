"""Config-driven, quality-gated batch jobs as plain Spark DataFrame plans."""
