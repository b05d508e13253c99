"""Spark-first analytics over document tables: pages, grids, facts, matching, review and evaluation."""
