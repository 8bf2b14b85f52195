"""Spark-native incremental loading, modelling and quality gating of versioned JSON records."""
