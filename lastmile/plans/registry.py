"""All registered queries: importing the modules fills the registry."""

from lastmile.plans import model_queries  # noqa: F401
from lastmile.plans.queries import QUERIES  # noqa: F401
