"""Whole reports, each one declarative plan over its inputs."""
