"""Relational operators of the medallion: cleaning, quality, marts, rules."""
