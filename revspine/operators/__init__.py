"""DataFrame operators: spine, windows, interval aggregation, series windows,
extraction and report figures."""
