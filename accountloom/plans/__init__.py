"""Layers of the pipeline: cleaning, staging, core models, dashboard, daily run."""
