"""Sources and sinks: header-tolerant delimited scans, manifests, tables, value lists and digests."""
