"""Landed documents and configuration turned into candidate tables."""
