"""Storefront listing, review and price analytics as Spark DataFrame jobs."""
