"""Direction-dependent column picks and the home-airport filter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by_direction(departure_value, arrival_value, direction="flight_direction") -> Column:
    """Departure-side value for departures, arrival-side for arrivals,
    NULL for any other direction."""
    d = _c(direction)
    return (F.when(d == "departure", _c(departure_value))
            .when(d == "arrival", _c(arrival_value)))


def home_airport_filter(home: str, direction="flight_direction",
                        departure_airport="airport_departure_iata",
                        arrival_airport="airport_arrival_iata") -> Column:
    """Operations at ``home``: its departures and its arrivals."""
    d = _c(direction)
    return (((_c(departure_airport) == home) & (d == "departure"))
            | ((_c(arrival_airport) == home) & (d == "arrival")))
