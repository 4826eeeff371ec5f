"""The registered queries: each module registers its own when it is imported."""

from tessera.plans import history, panel, quality, research, scalars, storage, temporal  # noqa: F401
