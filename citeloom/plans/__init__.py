"""End-to-end runs: search, resolve, merge, full text; with run folders, sinks and manifests."""
