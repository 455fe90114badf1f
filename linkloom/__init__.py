"""Crawl analytics on Spark: score captured pages, rank links, keep a frontier, report."""
