"""Sources and sinks: file readers, report writers, TESTDATA-derived input tables."""
