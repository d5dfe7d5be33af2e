"""The operators as queries over the given tables, with SQL to check them by."""
