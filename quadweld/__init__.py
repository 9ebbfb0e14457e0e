"""Quad fusion on Spark: many sources in, one clean set of statements out."""

from quadweld.plans.config import FusionConfig, Strategy
from quadweld.plans.fuse import Fusion, fuse

__all__ = ["Fusion", "FusionConfig", "Strategy", "fuse"]
