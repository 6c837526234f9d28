"""tessera: a Spark-native engine for time-stamped transcripts and the quality metrics around them."""
