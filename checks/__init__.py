"""Registered queries over the given test tables, and the SQL that checks them."""
