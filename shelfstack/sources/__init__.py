"""File readers, the dataset registry and catalog reads."""
