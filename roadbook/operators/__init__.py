"""DataFrame operators of the fleet warehouse."""
