"""All registered queries; importing a module registers its queries."""

from checks import q_drift, q_eval, q_features, q_ingest, q_listings, q_models, q_streams  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
