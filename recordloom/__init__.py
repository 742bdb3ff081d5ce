"""recordloom: Spark-native processing of public-information request archives."""
