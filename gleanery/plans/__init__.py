"""Whole jobs put together from the stages."""
