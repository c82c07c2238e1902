"""Reusable distributed plan shapes (segmented prefix scans, row frames)."""

from sensorflow.plans.scan import Run, scan, with_halo, with_segments  # noqa: F401
