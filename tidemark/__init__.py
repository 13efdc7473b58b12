"""Point-in-time-safe analytics over event histories, on Spark SQL."""
