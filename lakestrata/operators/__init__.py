"""Relational operators of the medallion flows, each a lazy DataFrame plan."""
