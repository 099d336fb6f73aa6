"""Product-catalogue feeds on Spark: extract, validate, clean, stage, keep history."""
