"""Checks of the library against a second engine on generic test tables."""
