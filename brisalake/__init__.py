"""brisalake: indicator lakehouse operators expressed as Spark DataFrame plans."""

from brisalake.session import build_session

__all__ = ["build_session"]
