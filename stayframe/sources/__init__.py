"""Sources and sinks: parquet tables, parameter CSV folders, experiment records."""
