"""Feature preparation and MLlib models."""
