"""Training-data operators; optional, nothing else in the library imports them."""
