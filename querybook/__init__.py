"""Registered queries: their inputs, the Spark form, and the SQL that checks them."""
