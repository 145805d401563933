"""Named queries of the engine."""

from acervo.plans import problems, reference  # noqa: F401
from acervo.plans.catalog import CORE as ALL  # noqa: F401
