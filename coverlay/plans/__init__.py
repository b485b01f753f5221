"""The cleaning of a locality layer, stage by stage; each stage is a function from DataFrames to DataFrames."""

from coverlay.plans.config import CleanConfig
from coverlay.plans.clean import clean

__all__ = ["CleanConfig", "clean"]
