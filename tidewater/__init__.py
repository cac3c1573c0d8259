"""tidewater: a Spark-native medallion lakehouse for match results."""
