"""Training-data operators: ten large-scale corpus operations, independent of the rest of the library."""
