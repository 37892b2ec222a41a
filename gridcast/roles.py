"""Column roles of a panel table."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Roles:
    """Names of the columns a panel operator needs.

    ``time``/``group`` key the panel, ``target`` is the normalised target,
    ``raw`` and ``capacity`` produce it when it is absent.
    """

    time: str = "delivery_time"
    group: str = "site_name"
    target: str = "production_normalized"
    raw: str = "production"
    capacity: str = "installed_capacity"

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)


DEFAULT_ROLES = Roles()
