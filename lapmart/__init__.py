"""lapmart: layered (raw -> bronze -> silver -> gold) motor-racing analytics on Spark."""

__version__ = "0.1.0"
