"""Sources and sinks: delimited files, lake layers, file listings."""
