"""The concrete pipeline: staging, episodes, marts, checks, model."""
