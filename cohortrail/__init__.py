"""Ad attribution and cohort statistics as Spark DataFrame operators."""
