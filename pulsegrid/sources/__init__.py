"""Readers for recordings and derived artifacts."""
