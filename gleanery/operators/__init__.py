"""Stages of the job; each takes and returns DataFrames."""
