"""DataFrame operators shared by the two books."""
