"""The assembled data product and the query catalogue."""
