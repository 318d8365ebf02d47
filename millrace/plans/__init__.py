"""Pipelines composed of the operators."""

from millrace.plans.analyze import Analysis, analyze
from millrace.plans.clean import CleanResult, clean
from millrace.plans.model import ModelResult, model
from millrace.plans.profile import profile

__all__ = ["Analysis", "CleanResult", "ModelResult", "analyze", "clean", "model", "profile"]
