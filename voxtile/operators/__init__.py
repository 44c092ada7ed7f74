"""DataFrame operators: tables in, tables out."""
