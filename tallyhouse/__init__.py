"""Preparation, checking, splitting and price modelling of listing tables on Spark."""
