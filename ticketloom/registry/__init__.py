"""All registered queries; importing the modules fills the catalogue."""

from ticketloom.registry import cleaning, evaluation, features, ingestion, optimality, scoring, training  # noqa: F401
from ticketloom.registry.catalog import ORACLES, QUERIES  # noqa: F401
