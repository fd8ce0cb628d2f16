"""Listing analytics and feature engineering as Spark DataFrame operators."""
