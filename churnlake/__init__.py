"""churnlake: Spark-native toolkit for tabular churn classification and for building training corpora at scale."""
