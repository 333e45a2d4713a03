"""Replay paths (O5, O6) and the test-path ``Comparison``; the stand-in
versions used by fixtures, tests and the bench live in ``standin``."""

from .replay import Comparison, repeatability, replay_pair, run_procedure

__all__ = ["Comparison", "repeatability", "replay_pair", "run_procedure"]
