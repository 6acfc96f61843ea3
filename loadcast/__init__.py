"""loadcast: smart-meter load averaging and short-term load forecasting on Spark."""

from .config import HOUSE, PLUG, PLUG_AS_WRITTEN, PLUG_ONLY, Entity, Options

__all__ = ["HOUSE", "PLUG", "PLUG_AS_WRITTEN", "PLUG_ONLY", "Entity", "Options"]
