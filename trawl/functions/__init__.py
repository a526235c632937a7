"""trawl.functions."""
