"""gazette: a Spark-native daily reading digest."""
