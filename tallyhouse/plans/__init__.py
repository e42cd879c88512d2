"""Reusable plan shapes: size-checked lookups and exact ranks without global sorts."""
