"""The query registry, one module per family."""


def all_queries():
    from tidewater.plans import relational, scalar, sequences, statements, streams, tables  # noqa: F401
    from tidewater.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
