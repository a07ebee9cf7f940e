from .ingest import IngestConfig, ingest, start, tick
from .commands import register, replay, revise
from .live import live_rates

__all__ = ["IngestConfig", "ingest", "live_rates", "register", "replay", "revise", "start", "tick"]
