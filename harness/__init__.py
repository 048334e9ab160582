"""Test inputs, registered queries and their SQL counterparts."""
