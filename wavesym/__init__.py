"""Symbolise numeric waveforms, compare them with templates and classify them, on Spark."""

from wavesym.settings import Scale, Spec

__all__ = ["Scale", "Spec"]
