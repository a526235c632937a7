"""trawl.streaming."""
