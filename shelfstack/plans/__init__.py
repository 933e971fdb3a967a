"""The Silver and Gold tables and the runs that fill them."""
