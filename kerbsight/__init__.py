"""Spark-first analytics for geo-referenced object detections."""
