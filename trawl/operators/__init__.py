"""trawl.operators."""
