"""The operators applied to the driver tables, each next to its SQL check."""
