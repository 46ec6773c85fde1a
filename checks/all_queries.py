"""Importing this module registers every query."""

import checks.scans_sinks  # noqa: F401
import checks.scalars  # noqa: F401
import checks.joining  # noqa: F401
import checks.aggregating  # noqa: F401
import checks.semistructured  # noqa: F401
import checks.projections  # noqa: F401
import checks.marts_core  # noqa: F401
import checks.marts_parking  # noqa: F401
import checks.marts_commerce  # noqa: F401
import checks.marts_services  # noqa: F401
import checks.marts_exchange  # noqa: F401
import checks.platform_exports  # noqa: F401
