"""Whole plans: the retraining cycle and the query catalogue."""
