"""gridcast: grouped time-series panels on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions. Column roles (time, group, target, raw target, capacity)
are passed as a :class:`~gridcast.roles.Roles` value instead of global
configuration.
"""

from gridcast.roles import Roles, DEFAULT_ROLES
from gridcast.session import get_session, use_utc, checkpoint_dir

__all__ = ["Roles", "DEFAULT_ROLES", "get_session", "use_utc", "checkpoint_dir"]
