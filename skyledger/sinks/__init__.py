"""Writers: declared tables, re-runnable appends, lookup layouts and JDBC."""
