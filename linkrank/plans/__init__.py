"""Runs made of several Spark jobs: preparing a graph and iterating on it."""
