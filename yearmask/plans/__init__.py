"""The registered queries. The registry comes first: it loads all modules in their order."""

from yearmask.plans import registry  # noqa: F401
