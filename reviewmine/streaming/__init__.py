"""Streaming use of fitted models."""
