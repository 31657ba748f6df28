"""Acoustic-event detection on Spark tables and streams."""

from acoustic_spark.config import DetectConfig, FeatureConfig
from acoustic_spark.plans.detect import detect, detect_clips

__all__ = ["DetectConfig", "FeatureConfig", "detect", "detect_clips"]
