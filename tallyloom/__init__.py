"""Month-end reporting analytics as ordinary Spark DataFrames.

Layout: ``sources`` reads and writes layers, ``functions`` holds column
expressions, ``operators`` holds DataFrame-to-DataFrame building blocks,
``plans`` composes them into rule packs and whole reporting jobs, and
``catalog`` places every operator on the shared test tables.
"""

from tallyloom.session import build_session, prepare

__all__ = ["build_session", "prepare"]
