"""Documents and tables to rows."""
