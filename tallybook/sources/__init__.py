"""Table schemas and the catalog that hands tables to the reports."""
