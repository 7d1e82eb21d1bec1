"""DataFrame operators: parse/validate, retention, table views, sequence patterns."""
