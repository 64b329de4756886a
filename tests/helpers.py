"""What the tests of several modules share."""

from datetime import datetime, timedelta


def at(ms):
    """Epoch milliseconds as a naive UTC time, as results show it."""
    return datetime(1970, 1, 1) + timedelta(milliseconds=ms)
