"""The operators bound to the driver tables, each with the SQL it must agree with."""
