"""trawl: web-archive pages to linked entities and relations, on Spark."""
