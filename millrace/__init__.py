"""Contract-checked ingest, time series, event-time streams, graphs and job-log
analytics as plain ``DataFrame -> DataFrame`` functions on Spark."""
