"""Events for small tests."""

from datetime import date, datetime, timedelta

from stayline import config as c

INSTALL = date(2024, 3, 1)
SCHEMA = c.FLAT_SCHEMA.replace("install_date timestamp", "install_date date")


def row(day, **values):
    """One event; ``day`` is a date or days after the install."""
    if isinstance(day, int):
        day = INSTALL + timedelta(days=day)
    base = {
        "user_pseudo_id": "u", "event_date": day, "event_name": "x", "install_date": INSTALL,
        "event_timestamp": int(datetime(day.year, day.month, day.day, 12).timestamp() * 1e6),
    }
    return {**base, **values}
