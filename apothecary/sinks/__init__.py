"""Writers for tables, figures and their catalogue."""
