"""Weekly marketing and e-commerce reporting as lazy Spark DataFrame jobs."""

from tidemark.model import Settings

__all__ = ["Settings"]
