"""medallion: a PySpark library for clinical-trial operations data.

Layers: sources -> bronze -> silver -> gold, driven by metadata tables.
Everything is DataFrame / SQL; see README.md for the module map.
"""

__all__ = ["session", "seed", "functions", "operators", "sources", "streaming", "plans"]
