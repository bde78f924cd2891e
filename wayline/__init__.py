"""Trajectory and training-corpus analytics on Spark."""
