"""All checks in one place."""

import queries.analyses  # noqa: F401
import queries.classification  # noqa: F401
import queries.distances  # noqa: F401
import queries.preparation  # noqa: F401
import queries.outlier_checks  # noqa: F401
from queries.base import QUERIES, SQL  # noqa: F401
