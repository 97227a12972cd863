"""All registered queries."""

from glimmerdex.plans import answers, preparation, search  # noqa: F401
from glimmerdex.plans.inputs import CHECKS, QUERIES  # noqa: F401
