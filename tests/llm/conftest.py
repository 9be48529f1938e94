"""The fixtures of the other tests also serve these."""
