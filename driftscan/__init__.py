"""driftscan: survey-imagery analytics and corpus preparation as PySpark DataFrame functions."""

__version__ = "0.1.0"
