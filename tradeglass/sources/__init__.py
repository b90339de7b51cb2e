"""Readers of landed data: payload DataFrames in, typed rows out."""
