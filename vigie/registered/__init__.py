"""Registered queries by theme; ``vigie.registry`` imports them all."""
