"""Training-data operators: search, extraction, quality, mixing, joins, packing, scans."""
