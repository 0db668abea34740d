"""Readers of deliveries and writers of histories."""
