"""Recipe text analytics on Spark: cleaning, curation, scoring and reports."""
