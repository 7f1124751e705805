"""Sources and sinks: each connector makes DataFrames of what lives elsewhere and writes DataFrames there."""
