"""Operators put in order: layer refreshes, and the checked workload."""
