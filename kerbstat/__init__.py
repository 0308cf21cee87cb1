"""Road-accident severity analytics as functions from DataFrame to DataFrame."""
