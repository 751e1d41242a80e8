"""Times of hand-made reports."""

from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1)


def at(days=0.0, minutes=0.0):
    return T0 + timedelta(days=days, minutes=minutes)
