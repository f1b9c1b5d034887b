"""Test inputs: entity files written from the driver's tables. Not part of the library.

Nothing here imports the library's reading code, so that an error in one cannot hide in the other.
"""
