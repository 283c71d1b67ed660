"""pathcredit: multi-touch marketing attribution over conversions and
recurring subscriptions, as lazy PySpark DataFrame plans.

Entry points: ``plans.pipeline.Pipeline`` (one build),
``streaming.incremental.run_incremental`` (one scheduled run),
``operators.overview.attribution_overview`` (the report), and
``python -m pathcredit`` (command line).
"""

from .config import AttributionConfig, ChannelRule, ConversionDef

__all__ = ["AttributionConfig", "ChannelRule", "ConversionDef"]
