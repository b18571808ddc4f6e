"""Flight-delay analytics as plain PySpark DataFrame functions."""
