"""Sources and sinks: table reads, the test-data ledger adapter, files, merges."""
