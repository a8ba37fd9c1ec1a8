"""Paired event feeds -> episodes -> rates, checks and a monitored risk model, on Spark."""
