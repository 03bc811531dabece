"""weft: a Spark-native engine for visit-log sessions, flat-file statistics
and nested JSON, built from DataFrame expressions, windows, joins and
aggregates.

Common entry points::

    from weft import get_spark, cut_sessions, SessionSpec, run_visit_job
"""

__version__ = "0.1.0"

from weft.operators.sessions import SessionSpec, cut_sessions, with_session_id  # noqa: E402,F401
from weft.plans.devices import datacenter_analysis, device_analysis  # noqa: E402,F401
from weft.plans.flights import flight_analysis  # noqa: E402,F401
from weft.plans.visits import build_sessions, clean_log, run_visit_job  # noqa: E402,F401
from weft.session import checkpoint_dir, get_spark  # noqa: E402,F401
