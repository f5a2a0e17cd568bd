"""Spark jobs that remove personal data from trace, log and annotation tables."""
from .config import Policy, PipelineConfig, parse_categories, parse_retention

__all__ = ["Policy", "PipelineConfig", "parse_categories", "parse_retention"]
