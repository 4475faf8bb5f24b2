"""Warehouse layers and the questions asked of them."""
