"""trawl.sources."""
