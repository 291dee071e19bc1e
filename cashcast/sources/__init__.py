"""Sources and sinks: catalog tables, parquet, and the fixture mapping of the test tables."""
