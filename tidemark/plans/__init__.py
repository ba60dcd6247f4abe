"""Jobs: ingest, training, forecasting."""
