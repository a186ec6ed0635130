"""Jobs: staging, maps, marts, metrics, page extracts and whole pipelines."""
