"""Registered queries with the equivalent SQL they are checked against."""
