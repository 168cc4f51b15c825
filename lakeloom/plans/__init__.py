"""Serving queries, the layered pipeline and the driver's queries."""
