"""Delivery-risk analytics on Spark: labels, leak-free features, checks, reports and models."""
