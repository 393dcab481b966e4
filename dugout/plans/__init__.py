"""Models and reports put together from the helpers."""
