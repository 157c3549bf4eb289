"""Telemetry and log anomaly analytics expressed as Spark jobs."""

from vigilseries.session import get_session

__all__ = ["get_session"]
__version__ = "0.1.0"
