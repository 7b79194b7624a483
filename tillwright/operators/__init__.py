"""DataFrame operators. None of them writes anything."""
