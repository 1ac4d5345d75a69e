"""Descriptions of what to move: table specs, type mapping, options and task plans."""
