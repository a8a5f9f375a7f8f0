"""Multi-label tagging of free text as lazy Spark DataFrame operators."""
