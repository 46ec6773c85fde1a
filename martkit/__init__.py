"""martkit: Spark-native operators and marts for a retail-loyalty warehouse."""
