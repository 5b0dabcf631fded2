"""Station demand analytics on Spark: trips in, hourly demand, features, models and forecasts out."""
