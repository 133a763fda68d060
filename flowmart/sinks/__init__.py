"""Sinks: lake tables, JDBC tables, and publishing of the marts to either."""
