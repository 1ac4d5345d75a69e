"""Reading: source tables, chunk bounds, catalogs and finished exports."""
