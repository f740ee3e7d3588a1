"""loamline: a Spark-native engine that turns multi-source text into a training-ready corpus."""
