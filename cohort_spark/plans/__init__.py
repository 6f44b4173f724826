"""End-to-end flows (W1-W5) and the registry of queries over the test tables."""
