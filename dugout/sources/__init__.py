"""Sources and sinks: typed CSV loading, TESTDATA fixtures, layered table sinks."""
