"""Weekly-issue video analytics as Spark DataFrame programs."""
