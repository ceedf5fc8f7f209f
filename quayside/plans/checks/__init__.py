"""Checked queries over the given tables; importing this package registers all of them."""

from quayside.plans.checks import (  # noqa: F401
    bundles,
    ciphers,
    discovery,
    exchange,
    folders,
    handover,
    landing,
    matching,
    messages,
    naming,
    numbering,
    summaries,
    typing,
)
