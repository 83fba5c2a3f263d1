"""Record linkage, de-identification and study summaries as Spark DataFrame operators."""
