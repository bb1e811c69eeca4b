"""Sources and sinks: the TESTDATA bronze adapter, file readers and mart writers."""
