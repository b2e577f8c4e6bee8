"""geomart: DataFrame operators for building a location-aware data mart on Spark."""
