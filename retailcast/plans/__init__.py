"""Named queries over the driver tables and their DuckDB oracle SQL."""


def load_registry():
    """Import every query module and return the filled registry."""
    from retailcast.plans import queries, queries_diag, queries_eval, queries_files, queries_ops  # noqa: F401
    from retailcast.plans.registry import REGISTRY
    return REGISTRY
