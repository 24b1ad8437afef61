"""Operators over the evidence tables; every one takes and returns DataFrames."""
