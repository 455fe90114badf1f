"""Column functions: URLs, HTML measures, scores, report texts."""
