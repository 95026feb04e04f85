"""All registered queries. Importing the section modules fills the registry."""

from holdfast.catalog import (  # noqa: F401
    aggregates,
    modelling,
    projections,
    sources,
    statistics,
    usage,
)
from holdfast.catalog.base import ORACLES, QUERIES  # noqa: F401
