"""A PySpark-native engine for zonal, temporal and comparative landscape analytics."""
