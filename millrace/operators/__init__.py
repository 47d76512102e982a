"""Relational operators over claims, snapshots, mentions, graphs and postings."""
