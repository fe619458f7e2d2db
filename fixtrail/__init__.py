"""Trajectory-anomaly analytics as Spark DataFrame operators."""

from fixtrail.config import ExperimentConfig, features_for_model

__all__ = ["ExperimentConfig", "features_for_model"]
