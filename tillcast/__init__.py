"""tillcast: retail sales analytics and forecasting on Spark."""
