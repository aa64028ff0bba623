"""Reading, landing and loading transaction files."""
