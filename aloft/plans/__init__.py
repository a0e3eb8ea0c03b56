"""User-facing question APIs and the registered table queries."""

from aloft.plans.flights import FlightAnalytics
from aloft.plans.places import PlaceAnalytics, SocialGraph
from aloft.plans.players import PlayerModel

__all__ = ["FlightAnalytics", "PlaceAnalytics", "PlayerModel", "SocialGraph"]
