"""DataFrame operators of the warehouse (see README for the inventory)."""
