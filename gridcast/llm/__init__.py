"""Training-data operators over ``documents``, ``pages``, ``benchmark``,
``labels`` and ``conversations``; nothing else in the library imports them."""
