"""Sources: test-table adapters, raw frame scans, wire topic, table scans."""
