"""shelfcast: retail demand features, forecasts and recommended orders on Spark."""
