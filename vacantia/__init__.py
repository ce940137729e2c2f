"""vacantia: a Spark-first analytics engine for public job-posting feeds."""
