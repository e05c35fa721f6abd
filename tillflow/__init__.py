"""Retail clickstream, purchase and customer analytics as Spark transforms."""
