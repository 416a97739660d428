"""storecast: retail transaction analytics expressed as lazy PySpark plans."""
