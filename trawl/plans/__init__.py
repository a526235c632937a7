"""trawl.plans."""
