"""Registered plans over the driver tables (imported for their registrations)."""

from . import trajectory_plans  # noqa: F401
from .registry import PLANS, Plan, plan  # noqa: F401
from . import source_plans, projection_plans  # noqa: F401,E402
from . import aggregate_plans  # noqa: F401,E402
from . import window_plans  # noqa: F401,E402
from . import scalar_plans  # noqa: F401,E402
from . import join_plans  # noqa: F401,E402
from . import layout_plans, udf_plans  # noqa: F401,E402
from . import stream_plans  # noqa: F401,E402
