"""Runners, fixtures and registered queries."""
