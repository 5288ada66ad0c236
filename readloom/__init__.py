"""Long-read analysis and corpus preparation as composable Spark DataFrame operators."""
