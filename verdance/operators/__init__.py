"""Operators on pixel, zone, scene and parcel tables."""
